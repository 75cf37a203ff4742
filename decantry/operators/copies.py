"""Rows as a multiset: which copies of what is delivered are not stored yet.

Rows of one digest are equal in all columns of the source, so what counts is how many
there are. Nothing here takes one task per digest: copies are counted, which tasks do for
their own rows first, and where only some copies of a row are new they are made from one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.typed import column_ref
from ..session import Scratch
from .matching import BROADCAST_BYTES

_HAVE, _MORE, _ROW = "__have", "__more", "__row"

# Bytes of a digest and its row in a join.
_DIGEST_BYTES = 100


def _few(rows: int) -> bool:
    return rows * _DIGEST_BYTES <= BROADCAST_BYTES


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _within(counts: DataFrame, n_rows: int, stored: DataFrame) -> DataFrame:
    """The digests of ``stored`` that ``counts`` has, one row per copy.

    One column is scanned. Up to 64 MB of digests, by their number, go to where it lies;
    more are shuffled with it.
    """
    wanted = _small(counts.select(L.ROW_DIGEST), _few(n_rows))
    return stored.select(L.ROW_DIGEST).join(wanted, L.ROW_DIGEST, "left_semi")


def _copies(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(L.ROW_DIGEST).agg(F.count(F.lit(1)).alias(name))


def _in_both(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The digests that both sides have, and how many copies each has of them.

    One grouping of both together, so that each side is shuffled once, and by the 32 bytes
    that a digest writes as 64 letters; what is not such a digest stays as it is.
    """
    sides = [
        side.select(L.ROW_DIGEST, F.lit(new).alias("__new"))
        for side, new in ((rows, True), (stored, False))
    ]
    raw, digest = F.unhex(L.ROW_DIGEST), F.col(L.ROW_DIGEST)
    raw = F.when(F.lower(F.hex(raw)) == digest, raw)
    return (
        sides[0]
        .union(sides[1])
        .filter(digest.isNotNull())
        .groupBy(raw.alias("__raw"), F.when(raw.isNull(), digest).alias("__text"))
        .agg(F.count_if("__new").alias("__n"), F.count_if(~F.col("__new")).alias(_HAVE))
        .filter((F.col("__n") > 0) & (F.col(_HAVE) > 0))
        .withColumn(L.ROW_DIGEST, F.coalesce(F.lower(F.hex("__raw")), F.col("__text")))
    )


def beyond(scratch: Scratch, rows: DataFrame, n_rows: int, stored: DataFrame | None) -> DataFrame:
    """The rows, copies of one another included, that are more than ``stored`` has of them.

    ``rows`` are ``n_rows`` in all and read several times: they should be stored.
    """
    if stored is None or not n_rows:
        return rows
    if _few(n_rows):
        counts = _copies(rows, "__n")
        have = _copies(_within(counts, n_rows, stored), _HAVE)
        both = have.join(counts, L.ROW_DIGEST)
    else:
        both = _in_both(rows, stored)
    known = both.select(L.ROW_DIGEST, (F.col("__n") - F.col(_HAVE)).alias(_MORE))
    known, found, partly = scratch.keep(known, F.col(_MORE) > 0)
    if not found:
        return rows
    names = [column_ref(c) for c in rows.columns]
    unknown = rows.join(_small(known, _few(found)), L.ROW_DIGEST, "left_anti").select(*names)
    if not partly:
        return unknown
    short = _small(known.filter(F.col(_MORE) > 0), _few(partly))
    copies = (
        rows.join(short, L.ROW_DIGEST)
        .groupBy(column_ref(L.ROW_DIGEST).alias("__digest"), _MORE)
        .agg(F.first(F.struct(*names)).alias(_ROW))
        .select(_ROW, F.explode(F.sequence(F.lit(1), F.col(_MORE))))
    )
    return unknown.unionByName(copies.select(f"{_ROW}.*"))


def still_missing(
    scratch: Scratch,
    rows: DataFrame,
    n_rows: int,
    stored: DataFrame | None,
    source: DataFrame | None,
    run: str | None,
) -> DataFrame:
    """Of rejects that pass by now, as many copies of each as ``stored`` lacks of ``source``.

    Runs may have rejected the same row again and again, so there can be more rejects than
    copies in the source; a row that the source has no more is not limited by it. Rejects
    have ids of their own, so which are taken matters: those of the last run that rejected
    just as many (``run`` is a column that tells runs apart), or else the smallest ids.
    """
    if not n_rows:
        return rows
    counts = _copies(rows, "__n")
    here = [
        _within(counts, n_rows, other).withColumn("__from", F.lit(name))
        for name, other in (("stored", stored), ("source", source))
        if other is not None
    ]
    needed = counts.withColumn(_MORE, F.col("__n"))
    if here:
        found = reduce(DataFrame.union, here).groupBy(L.ROW_DIGEST).agg(
            F.count_if(F.col("__from") == "stored").alias("__stored"),
            F.count_if(F.col("__from") == "source").alias("__source"),
        )
        limit = F.when(F.col("__source") > 0, F.col("__source")).otherwise(F.col("__n"))
        lacking = F.coalesce(limit - F.col("__stored"), F.col("__n"))
        needed = counts.join(found, L.ROW_DIGEST, "left").withColumn(_MORE, F.least("__n", lacking))
    some = F.col(_MORE) < F.col("__n")
    needed = needed.filter(F.col(_MORE) > 0).select(L.ROW_DIGEST, "__n", _MORE)
    needed, digests, partly = scratch.keep(needed, some)

    # A struct as key leaves the rows of a frequent digest to be split over tasks.
    match = F.struct(L.ROW_DIGEST)
    names = [column_ref(c) for c in rows.columns]
    keyed = rows.withColumn(_ROW, match)
    whole = needed.filter(~some).select(match.alias(_ROW))
    taken = keyed.join(_small(whole, _few(digests)), _ROW).select(*names)
    if not partly:
        return taken
    in_part = _small(needed.filter(some).drop("__n"), _few(partly))
    if run:
        per_run = rows.join(in_part, L.ROW_DIGEST).groupBy(L.ROW_DIGEST, _MORE, run)
        fitting = per_run.agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == F.col(_MORE))
        last = fitting.groupBy(L.ROW_DIGEST).agg(F.max(run).alias("__run"))
        last, runs = scratch.keep(last)
        of_run = keyed.join(_small(last.select(match.alias(_ROW), "__run"), _few(runs)), _ROW)
        taken = taken.unionByName(of_run.filter(F.col(run) == F.col("__run")).select(*names))
        if runs == partly:
            return taken
        in_part = in_part.join(_small(last, _few(runs)), L.ROW_DIGEST, "left_anti")
    # No run fits: one died half-way, or the source has lost copies.
    place = F.row_number().over(Window.partitionBy(L.ROW_DIGEST).orderBy(L.QUARANTINE_ID))
    ranked = rows.join(in_part, L.ROW_DIGEST).withColumn("__place", place)
    return taken.unionByName(ranked.filter(F.col("__place") <= F.col(_MORE)).select(*names))
