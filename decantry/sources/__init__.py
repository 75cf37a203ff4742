from .commits import CommitLog, commit_metrics
from .contracts import CONTRACT_SCHEMA, read_contracts
from .tables import SchemaConflict, Table, align_to

__all__ = [
    "CONTRACT_SCHEMA",
    "CommitLog",
    "SchemaConflict",
    "Table",
    "align_to",
    "commit_metrics",
    "read_contracts",
]
