"""Row matching on caller-given columns. NULL matches NULL.

A pipeline matches rows on the digest of their content, never on columns that several
different rows may share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.typed import column_ref

_KEY = "__match_key"

# Keys up to this many bytes are sent to every executor instead of shuffling the
# rows they are matched with. The size is measured, never assumed.
BROADCAST_BYTES = 64 << 20


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Members of a struct compare as equal where both are NULL.
    return df.withColumn(_KEY, F.struct(*(column_ref(k).alias(k) for k in keys)))


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Copies of a key collapse within tasks before they are shuffled.

    The grouping is on the columns but the result is a struct of them, so a join
    on it shuffles again. That is cheap, as keys are unique by then, and it is what
    lets adaptive execution split a hot key on the other side of the join.
    """
    return _keyed(df.select(*(column_ref(k) for k in keys)).distinct(), keys).select(_KEY)


def _fits(df: DataFrame, keys: Sequence[str], limit: int) -> bool:
    """Whether all keys of ``df``, copies included, are within ``limit`` bytes.

    One aggregate, so that a ``df`` with a lineage of its own is computed once for it.
    """
    per_row = F.lit(16 * len(keys))
    for k in keys:
        per_row += F.coalesce(F.octet_length(column_ref(k).cast("string")), F.lit(0))
    size = df.agg(F.sum(per_row.cast("bigint")).alias("n")).first()["n"] or 0
    return size <= limit


def _without(df: DataFrame, found: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    if small:
        found = F.broadcast(found)
    return _keyed(df, keys).join(found, _KEY, "left_anti").drop(_KEY)


def without_matches(
    df: DataFrame, other: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``.

    Few keys are broadcast. Many are shuffled with ``df``, and a key that holds
    a large share of ``df``'s rows is spread over several tasks.
    """
    small = _fits(other, keys, broadcast_bytes)
    return _without(df, _distinct_keys(other, keys), keys, small)


def without_matches_in_large(
    df: DataFrame, other: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``without_matches`` for an ``other`` far larger than ``df``.

    ``other`` is first cut down to the keys ``df`` has. If those are few, they are
    broadcast and ``other`` is scanned without being shuffled; what it has of them
    is no larger, so it is broadcast in turn.
    """
    wanted = _distinct_keys(df, keys)
    small = _fits(df, keys, broadcast_bytes)
    present = _keyed(other.select(*(column_ref(k) for k in keys)), keys).join(
        F.broadcast(wanted) if small else wanted, _KEY, "left_semi"
    )
    return _without(df, _distinct_keys(present, keys), keys, small)
