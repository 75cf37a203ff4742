"""Lineage columns of ingested rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L


def as_instant(ts: dt.datetime | Column | None) -> Column:
    if ts is None:
        return F.current_timestamp()
    return ts if isinstance(ts, Column) else F.lit(ts)


def with_ingest_metadata(
    df: DataFrame,
    source: str | Column,
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """Add ingestion time, source and ingestion day (as text).

    ``source`` is the path the caller read; pass ``F.col("_metadata.file_path")``
    on a file scan to name each row's own file instead.
    """
    at = as_instant(run_ts)
    return df.withColumns(
        {
            L.INGESTED_AT: at,
            L.SOURCE_FILE: source if isinstance(source, Column) else F.lit(source),
            L.INGESTED_ON: F.date_format(at, "yyyy-MM-dd"),
        }
    )
