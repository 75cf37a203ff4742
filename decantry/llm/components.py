"""Connected components of an edge table, by alternating stars.

In each round every node's neighbours are pointed at its smallest one, first those
larger than the node, then all. The number of rounds grows with the logarithm of the
longest path. Per node only a minimum is gathered, so a node with very many neighbours
needs no task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_unique, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        join_unique(both, least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_unique(edges, least, "a").filter(F.col("b") != F.col("m"))
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for each node that is
    not a root. ``edges`` has two columns of one type; loops and NULLs are left out."""
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = stored(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    before = _state(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
