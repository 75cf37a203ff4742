"""Reprocessing attempts of quarantined rows.

Parquet has no MERGE, and rewriting a table that is being read destroys it. So
attempts go to a table of their own that only grows, and reading quarantine
folds them in. Where the format has MERGE the columns are updated in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import labels as L
from .ingest import as_instant

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField(L.QUARANTINE_ID, T.StringType()),
        T.StructField(L.REPROCESSED_AT, T.TimestampType()),
    ]
)


def with_attempts(rows: DataFrame, attempts: DataFrame | None) -> DataFrame:
    """Quarantined rows with their attempt count and the time of the last one.

    Ids are unique in ``rows`` and made unique in ``attempts`` by aggregation, so
    no key of this join is hot.
    """
    earlier = (
        F.col(L.REPROCESSED_AT)
        if L.REPROCESSED_AT in rows.columns
        else F.lit(None).cast("timestamp")
    )
    if attempts is None:
        return rows.withColumn(L.REPROCESSED_AT, earlier)
    made = attempts.groupBy(L.QUARANTINE_ID).agg(
        F.count(F.lit(1)).cast("int").alias("__made"),
        F.max(L.REPROCESSED_AT).alias("__last"),
    )
    return (
        rows.join(made, L.QUARANTINE_ID, "left")
        .withColumns(
            {
                L.ATTEMPTS: F.col(L.ATTEMPTS) + F.coalesce("__made", F.lit(0)),
                L.REPROCESSED_AT: F.coalesce(F.col("__last"), earlier),
            }
        )
        .select(*rows.columns, *([] if L.REPROCESSED_AT in rows.columns else [L.REPROCESSED_AT]))
    )


def merge_attempts(
    path: str, moved: DataFrame, run_ts: dt.datetime | Column | None = None
) -> None:
    """Count one attempt for every moved id in a Delta table, in place."""
    source = moved.select(L.QUARANTINE_ID).distinct().withColumn("__at", as_instant(run_ts))
    target = path.replace("`", "``")
    source.sparkSession.sql(
        f"MERGE WITH SCHEMA EVOLUTION INTO delta.`{target}` AS t USING {{moved}} AS m"
        f" ON t.{L.QUARANTINE_ID} = m.{L.QUARANTINE_ID}"
        f" WHEN MATCHED THEN UPDATE SET {L.ATTEMPTS} = t.{L.ATTEMPTS} + 1,"
        f" {L.REPROCESSED_AT} = m.__at",
        moved=source,
    )
