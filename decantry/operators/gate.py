"""The quality gate: verdict columns, and the split into clean and quarantined rows.

Everything here is a row function over the input, so a gate adds no shuffle.
The two sides are separate filters over the stored input rather than one cached
frame: the clean side then prunes row groups on the rules themselves, the
rejected side skips every row group whose statistics rule out a defect, and
nothing the size of the input is held in executor memory or on local disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.rules import RuleSet
from ..functions.typed import column_ref
from .ingest import as_instant


def validate(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Add the verdict: the single checks, their conjunction, reasons and code."""
    return df.withColumns(
        {
            L.CHECKS: rules.checks,
            L.IS_VALID: rules.passed,
            L.REASONS: rules.reasons,
            L.CODE: rules.code,
        }
    )


def clean(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows that pass every rule."""
    return df.filter(rules.passed)


def quarantine(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All other rows, with their verdict."""
    return validate(df.filter(rules.rejected), rules)


def split(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """Clean and rejected rows; together they are exactly ``df``."""
    return clean(df, rules), quarantine(df, rules)


def judged(
    df: DataFrame,
    rules: RuleSet,
    pipeline_version: str = "v1",
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """All rows, those that fail with verdict and audit columns, which are NULL for the others."""
    both = audit(validate(df, rules).withColumn(L.DUE_ON, rules.due), pipeline_version, run_ts)
    failed = ~F.coalesce(rules.passed, F.lit(False))
    own = set(df.columns)
    return both.select(
        *(
            column_ref(c) if c in own else F.when(failed, column_ref(c)).alias(c)
            for c in both.columns
        )
    )


def with_reason(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rejected rows with nothing but their reason added."""
    return df.filter(rules.rejected).withColumn(L.REJECT_REASON, rules.reasons)


def row_id(key: Sequence[str] | None, run_ts: Column) -> Column:
    """Identifier of a quarantined row.

    A random UUID, or a digest of ``key`` and the run's time where the caller
    knows columns that identify a row. The digest comes out the same when a
    lost task is run again.
    """
    if not key:
        return F.expr("uuid()")
    # A length prefix keeps neighbouring values from running into each other.
    parts = [
        F.when(column_ref(k).isNull(), F.lit("-")).otherwise(
            F.concat(
                F.length(column_ref(k).cast("string")).cast("string"),
                F.lit(":"),
                column_ref(k).cast("string"),
            )
        )
        for k in key
    ]
    return F.sha2(F.concat_ws("|", *parts, run_ts.cast("string")), 256)


def audit(
    rejected: DataFrame,
    pipeline_version: str = "v1",
    run_ts: dt.datetime | Column | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Add the audit columns of the quarantine table to validated rejects."""
    at = as_instant(run_ts)
    return rejected.withColumns(
        {
            L.REJECT_REASON: F.col(L.REASONS),
            L.VALIDATED_AT: at,
            L.PIPELINE_VERSION: F.lit(pipeline_version),
            L.QUARANTINE_ID: row_id(key, at),
            L.ATTEMPTS: F.lit(0),
            L.VALIDATED_ON: F.to_date(at),
        }
    )
