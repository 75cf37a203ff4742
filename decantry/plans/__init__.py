from .lakehouse import Lakehouse
from .runs import Refinement, Rules, gate_writes, ingest, refine, refresh_gold, reprocess
from .simple import ingest_snapshot, refine_simple

__all__ = [
    "Lakehouse",
    "Refinement",
    "Rules",
    "gate_writes",
    "ingest",
    "ingest_snapshot",
    "refine",
    "refine_simple",
    "refresh_gold",
    "reprocess",
]
