from . import gating, lakes, reporting  # noqa: F401  (they fill the registry)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
