"""Business aggregates over clean rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import labels as L
from ..functions.typed import column_ref, numeric_value


def group_totals(
    df: DataFrame,
    group: str,
    amount: str,
    total: str = L.TOTAL_CONTRACTED,
    by: Sequence[str] = (),
) -> DataFrame:
    """Sum of ``amount`` per ``group``; rows without a group form one of their own.

    With ``by`` there is one sum for each value of these columns as well.

    Sums are doubles, except that a decimal amount keeps its exact type. Every
    task sums its own rows first, so a shuffle carries one row per group and
    task however unevenly rows are spread over the groups.
    """
    value = numeric_value(df, amount)
    if not isinstance(df.schema[amount].dataType, T.DecimalType):
        value = value.cast("double")
    keys = [column_ref(c).alias(c) for c in (*by, group)]
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


def top_n(df: DataFrame, measure: str, tie_breaker: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest measure; ties go to the smaller tie breaker."""
    return df.orderBy(
        column_ref(measure).desc_nulls_last(), column_ref(tie_breaker).asc_nulls_last()
    ).limit(n)


def top_groups(
    df: DataFrame,
    group: str = L.DEPARTMENT,
    amount: str = L.PRICE,
    n: int = 10,
    total: str = L.TOTAL_CONTRACTED,
) -> DataFrame:
    """Groups with the largest totals, as doubles."""
    top = top_n(group_totals(df, group, amount, total), total, group, n)
    return top.withColumn(total, column_ref(total).cast("double"))
