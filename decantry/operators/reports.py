"""Quality reports over the quarantine and silver tables.

Each aggregate reduces to one row per day, reason or layer within the tasks
before anything is shuffled; each top-k keeps k rows per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.rules import as_day
from ..functions.typed import column_ref


def reason_counts(rejects: DataFrame, count: str = "count") -> DataFrame:
    return rejects.groupBy(L.REJECT_REASON).agg(F.count(F.lit(1)).alias(count))


def daily_rejects(
    rejects: DataFrame, codes: Mapping[str, str] = L.REPORT_CODES
) -> DataFrame:
    """Rejected rows per validation day: all of them, and those of each code."""
    return (
        rejects.groupBy(F.to_date(L.VALIDATED_AT).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("total_quarantined"),
            *(F.count_if(F.col(L.CODE) == code).alias(name) for name, code in codes.items()),
        )
        .orderBy(F.desc("day"))
    )


def reject_pct_by_day(rejects: DataFrame, accepted: DataFrame) -> DataFrame:
    """Share of rejects among the rows of a day, for the days that have rejects.

    A reject counts on the day it was validated, an accepted row on the day it
    was ingested. Both sides are one row per day when they are joined.
    """
    q = rejects.groupBy(F.to_date(L.VALIDATED_AT).alias("day")).agg(
        F.count(F.lit(1)).alias("q_count")
    )
    s = accepted.groupBy(F.to_date(L.INGESTED_AT).alias("day")).agg(
        F.count(F.lit(1)).alias("s_count")
    )
    pct = F.lit(Decimal("100.0")) * F.col("q_count") / (F.col("q_count") + F.col("s_count"))
    return (
        q.join(s, "day", "left")
        .withColumn("s_count", F.coalesce("s_count", F.lit(0)))
        .select("day", "q_count", "s_count", F.round(pct, 2).cast("double").alias("reject_pct"))
        .orderBy(F.desc("day"))
    )


def top_reasons(
    rejects: DataFrame, as_of: dt.date | Column | None = None, days: int = 30, n: int = 10
) -> DataFrame:
    """Most frequent reasons among the rows validated in the last ``days`` days.

    Of a stored quarantine only the folders of those days are read.
    """
    first = F.date_sub(as_day(as_of), days)
    recent = rejects.filter(
        F.col(L.VALIDATED_AT) >= first.cast(rejects.schema[L.VALIDATED_AT].dataType)
    )
    if L.VALIDATED_ON in rejects.columns:
        # Rows stored before there was such a column have none.
        day = F.col(L.VALIDATED_ON)
        recent = recent.filter((day >= first) | day.isNull())
    return (
        reason_counts(recent, "cnt")
        .orderBy(F.desc("cnt"), F.asc(L.REJECT_REASON))
        .limit(n)
    )


def recent_invalid(
    rejects: DataFrame,
    entity: str = L.ENTITY,
    price: str = L.PRICE,
    signed_on: str = L.SIGNED_ON,
    tie_breaker: str = L.QUARANTINE_ID,
    n: int = 50,
) -> DataFrame:
    """The ``n`` rows rejected last."""
    return (
        rejects.orderBy(F.col(L.VALIDATED_AT).desc_nulls_last(), column_ref(tie_breaker).asc())
        .limit(n)
        .select(
            column_ref(entity),
            column_ref(price),
            column_ref(signed_on),
            L.REJECT_REASON,
            L.VALIDATED_AT,
        )
    )


def sample_rejects(
    rejects: DataFrame,
    entity: str = L.ENTITY,
    price: str = L.PRICE,
    signed_on: str = L.SIGNED_ON,
    n: int = 10,
) -> DataFrame:
    """Any ``n`` rejected rows, for display."""
    return rejects.select(
        column_ref(entity), column_ref(price), column_ref(signed_on), L.REJECT_REASON
    ).limit(n)


def _rows_of(layer: str) -> Column:
    """Rows that the last commit of a layer stands for, whether or not all were new."""
    value = F.sum(F.when(F.col("layer") == layer, F.col("judged")))
    return F.coalesce(value, F.lit(0)).alias(f"{layer}_rows")


def _bytes_of(layer: str) -> Column:
    return F.sum(F.when(F.col("layer") == layer, F.col("bytes"))).alias(f"{layer}_bytes")


def layer_balance(metrics: DataFrame) -> DataFrame:
    """Rows per layer and the valid and rejected shares, one row per table set."""

    def share(part: str) -> Column:
        pct = F.lit(Decimal("100.0")) * F.col(part) / F.col("total_rows")
        return (
            F.when(F.col("total_rows") > 0, F.round(pct, 1).cast("double"))
            .otherwise(F.lit(0.0))
        )

    return (
        metrics.groupBy("table_set")
        .agg(
            _rows_of("bronze"),
            _rows_of("silver"),
            _rows_of("quarantine"),
            _bytes_of("silver"),
            _bytes_of("quarantine"),
        )
        .withColumn("total_rows", F.col("silver_rows") + F.col("quarantine_rows"))
        .withColumn("valid_pct", share("silver_rows"))
        .withColumn("rejected_pct", share("quarantine_rows"))
    )


def layer_comparison(
    metrics: DataFrame, layers: tuple[str, ...] = ("silver", "quarantine")
) -> DataFrame:
    """Rows per layer, with one column per layer and one row per table set."""
    return metrics.groupBy("table_set").agg(
        *(_rows_of(layer) for layer in layers)
    )
