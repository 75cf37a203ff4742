from .attempts import ATTEMPT_SCHEMA, with_attempts
from .gate import audit, clean, quarantine, split, validate
from .gold import group_totals, top_groups, top_n
from .ingest import with_ingest_metadata
from .matching import without_matches
from .reports import (
    daily_rejects,
    layer_balance,
    layer_comparison,
    reason_counts,
    recent_invalid,
    reject_pct_by_day,
    sample_rejects,
    top_reasons,
)

__all__ = [
    "ATTEMPT_SCHEMA",
    "audit",
    "clean",
    "daily_rejects",
    "group_totals",
    "layer_balance",
    "layer_comparison",
    "quarantine",
    "reason_counts",
    "recent_invalid",
    "reject_pct_by_day",
    "sample_rejects",
    "split",
    "top_groups",
    "top_n",
    "top_reasons",
    "validate",
    "with_attempts",
    "with_ingest_metadata",
    "without_matches",
]
