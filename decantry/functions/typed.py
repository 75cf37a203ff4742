"""Comparable values from columns whose stored type varies.

A column that already has the right type is returned as it is, because a cast
around it would keep the comparison from reaching the Parquet scan. Text is
parsed leniently: what does not parse is NULL, whether or not ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_ref(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_value(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return column_ref(name)
    if isinstance(dtype, (T.StringType, T.NullType)):
        return column_ref(name).try_cast("double")
    raise TypeError(f"column {name!r} of type {dtype.simpleString()} is not numeric")


def date_operand(df: DataFrame, name: str) -> Column:
    """What decides whether ``name`` holds a date at all."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column_ref(name)
    if isinstance(dtype, (T.StringType, T.NullType)):
        return column_ref(name).try_cast("date")
    raise TypeError(f"column {name!r} of type {dtype.simpleString()} is not a date")


def on_or_before(df: DataFrame, name: str, day: Column) -> Column:
    """``name``'s date is not after ``day``.

    For a timestamp the test is "before the next midnight" instead of a cast of
    the column, which compares the same and still prunes row groups.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return column_ref(name) < F.date_add(day, 1).cast(dtype)
    return date_operand(df, name) <= day
