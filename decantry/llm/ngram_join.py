"""Similarity join on word n-grams: MinHash banding, then full n-gram sets.

1. One pass gives each row the hash of its n-gram set and one hash per band of its
   MinHash signature. Rows with equal sets are one class from here on.
2. Band hashes are shuffled. A bucket's classes are candidates of each other; buckets
   are joined up into groups by pointing at their smallest class, never pair by pair.
3. A group's n-gram sets meet in tasks of bounded size: a large group is dealt into
   blocks, and each two blocks meet in a task. Sets are compared as a whole there, and
   what comes out is a row per class and task: its links, and one class it is linked to.
   Pairs are never written, so the rows do not grow with the square of a group; the
   comparisons within a group of different, mutually alike texts do.
4. The links' components are the classes of documents.

Bands are chosen so that a pair at the threshold becomes a candidate with at least the
target recall. Within a group all pairs are compared, candidates or not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, join_unique, mix64, stored, text_of
from .components import components
from .substring import WordHashes, rolling

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
SIGNATURE = 128
BLOCK_GRAMS = 100_000  # n-grams a block has on average

_WORDS = WordHashes()
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float, signature: int = SIGNATURE) -> tuple[int, int]:
    """Bands and rows per band: the most rows with which a pair at the threshold shares a
    band with at least this probability."""
    for rows in range(signature, 0, -1):
        bands = signature // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no banding of this signature reaches the recall")


def gram_set(raw: bytes, gram: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams. Fewer words than ``gram`` are one n-gram,
    none are none."""
    words = raw.split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(_WORDS(words)[:1], min(gram, len(words)))[0])


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per band for each of the sets, none of which is empty."""
    seeds = mix64(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * _FACTOR)
    out = np.zeros((len(sets), bands), np.uint64)
    first = 0
    while first < len(sets):  # a stretch of sets whose values stay in a core's cache
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= 1 << 16):
            size += len(sets[last])
            last += 1
        values = np.concatenate(sets[first:last])
        at = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        for band in range(bands):
            h = np.full(last - first, band, np.uint64)
            for k in range(band * rows, band * rows + rows):
                least = np.minimum.reduceat((values ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1)), at)
                h = mix64(h * _FACTOR + least)
            out[first:last, band] = h
        first = last
    return out


def _signed(docs: DataFrame, doc_id: str, text: str, gram: int, bands: int, rows: int) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [gram_set(x.as_py() or b"", gram) for x in batch.column("text").cast(pa.binary())]
            full = [i for i, s in enumerate(sets) if len(s)]
            found = band_hashes([sets[i] for i in full], bands, rows).astype(np.int64)
            nodes: list[bytes | None] = [None] * len(sets)
            signed: list[np.ndarray | None] = [None] * len(sets)
            for i, hashes in zip(full, found, strict=True):
                nodes[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                signed[i] = hashes
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(nodes, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(signed, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "node", "n_grams", "bands"],
            )

    rows_in = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text_of(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return rows_in.mapInArrow(
        work, f"doc_id {kind}, text_hash long, node binary, n_grams long, bands array<long>"
    )


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """``node`` and ``root`` of classes that share a bucket with another, roots included."""
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = (
        placed.groupBy("bucket")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("bucket", "least")
    )
    edges = join_unique(placed, buckets, "bucket").select("node", "least")
    found = components(edges)
    return found.unionByName(found.select("root", "root").toDF("node", "root").distinct())


def compare(sets: list[np.ndarray], rows: range, columns: range, threshold: float) -> np.ndarray:
    """Which of ``rows`` are linked to which of ``columns``."""
    sizes = np.array([len(s) for s in sets])
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    several = np.bincount(inverse, minlength=len(values)) > 1
    number = np.cumsum(several) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    keep = several[inverse]
    owner, gram = owner[keep], number[inverse[keep]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    common = np.zeros((len(rows), len(columns)), np.float32)
    width = 4096
    for start in range(0, int(several.sum()), width):
        lo, hi = np.searchsorted(gram, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], gram[lo:hi] - start] = 1
        common += part[rows.start : rows.stop] @ part[columns.start : columns.stop].T
    common = common.astype(np.int64)
    union = sizes[rows.start : rows.stop, None] + sizes[None, columns.start : columns.stop] - common
    return 1000 * common >= round(1000 * threshold) * union


def _forest(n: int, linked: list[tuple[int, int]]) -> list[int]:
    """For each of n things the first one it is linked to, over any number of links."""
    top = list(range(n))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i, j in linked:
        a, b = root(i), root(j)
        if a != b:
            top[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _links_of_task(
    rows: list[tuple], alone: bool, threshold: float
) -> Iterator[tuple[bytes, int, bytes]]:
    """Of the classes of one task: node, documents linked to it here, a linked node.

    Rows are (block, node, copies, set). Two blocks meet, of which one may be empty, or
    one is ``alone``: pairs within a block are left to the task where it is that.
    """
    seen: set[bytes] = set()
    rows = [r for r in sorted(rows, key=lambda r: r[:2]) if not (r[1] in seen or seen.add(r[1]))]
    copies = np.array([r[2] for r in rows])
    sets = [np.frombuffer(r[3], np.uint64) for r in rows]
    blocks = [r[0] for r in rows]
    cut = blocks.count(blocks[0])
    if not alone and cut == len(rows):
        return
    mine = range(len(rows)) if alone else range(cut)
    theirs = range(len(rows)) if alone else range(cut, len(rows))
    linked = compare(sets, mine, theirs, threshold)
    if alone:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(rows), np.int64)
    links[mine.start : mine.stop] += linked @ copies[theirs.start : theirs.stop]
    if not alone:
        links[theirs.start : theirs.stop] += linked.T @ copies[mine.start : mine.stop]
    pairs = [(i + mine.start, j + theirs.start) for i, j in np.argwhere(linked).tolist()]
    roots = _forest(len(rows), pairs)
    for row, n, root in zip(rows, links.tolist(), roots, strict=True):
        if n:
            yield row[1], n, rows[root][1]


def _verified(
    docs: DataFrame, classes: DataFrame, groups: DataFrame, doc_id: str, text: str, gram: int,
    threshold: float, block_grams: int,
) -> DataFrame:
    """``node``, ``links`` and ``to``: a row per class and task in which it has links."""
    sizes = (
        groups.join(classes.select("node", "n_grams"), "node")
        .groupBy("root")
        .agg(F.ceil(F.sum("n_grams") / block_grams).cast("int").alias("n_blocks"))
    )
    wanted = (
        groups.join(classes.drop("bands", "n_grams"), "node")
        .join(sizes, "root")
        .select(
            "root", "node", "copies", "n_blocks", F.col("holder.doc_id").alias("held_id"),
            F.col("holder.text_hash").alias("held_hash"),
            F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block"),
        )
    )
    with_text = docs.select(
        F.col(doc_id).alias("row_id"),
        F.xxhash64(text_of(text)).alias("row_hash"),
        F.col(text).alias("text"),
    ).join(
        wanted,
        F.col("row_id").eqNullSafe(F.col("held_id")) & (F.col("row_hash") == F.col("held_hash")),
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_set(x.as_py(), gram).tobytes() for x in batch.column("text").cast(pa.binary())]
            names = ["root", "node", "copies", "n_blocks", "block"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, pa.binary())],
                names=[*names, "grams"],
            )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j")), strict=True)
            columns = (batch.column(c).to_pylist() for c in ("block", "node", "copies", "grams"))
            for key, row in zip(keys, zip(*columns, strict=True), strict=True):
                if rows and key != at:
                    yield from result(at, rows)
                    rows = []
                at = key
                rows.append(row)
        if rows:
            yield from result(at, rows)

    def result(key: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = list(_links_of_task(rows, key[1] == key[2], threshold))
        if found:
            nodes, links, to = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(to, pa.binary())],
                names=["node", "links", "to"],
            )

    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met = (
        with_text.select("text", "root", "node", "copies", "n_blocks", "block")
        .mapInArrow(
            sets, "root binary, node binary, copies long, n_blocks int, block int, grams binary"
        )
        .withColumn("other", other)
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other", "n_blocks")
        .repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
    )
    return met.mapInArrow(tasks, "node binary, links long, to binary")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``text_hash``, ``class_id``, ``n_links`` and
    ``first``, true for the rows that stand for their class.

    Rows are linked when their sets of ``gram`` consecutive words have a Jaccard likeness
    of at least ``threshold``; texts of fewer words are one n-gram. A class is what links
    connect, and its id the smallest id in it; ``n_links`` counts the other rows that a
    row is linked to, copies included. The class is stood for by its smallest id, among
    repeated ids by one text; rows repeated as a whole share all results.

    NULL and empty texts have no n-grams and no links, and are their own classes. Rows
    with a NULL id take part, but only name a class that has no other id.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = stored(_signed(docs, doc_id, text, gram, bands, rows))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = stored(
        signed.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min(row).alias("holder"),
            F.first("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        )
    )
    groups = stored(_candidate_groups(classes))
    links = stored(
        _verified(docs, classes, groups, doc_id, text, gram, threshold, block_grams)
    )
    joined = components(links.select("node", "to"))
    of = (
        classes.select("node", "copies", "holder")
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(joined, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    heads = of.groupBy("root").agg(F.min("holder").alias("head"))
    named = of.join(heads, "root").select(
        "node",
        "head",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    own = (F.col("doc_id").eqNullSafe(F.col("head.doc_id"))) & (
        F.col("text_hash") == F.col("head.text_hash")
    )
    return join_unique(signed, named, "node", "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("head").isNull() | own).alias("first"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class; of rows repeated as a whole, one."""
    found = near_duplicates(docs, doc_id, text, **options).filter("first")
    key, digest, own = (free_name(c, docs) for c in ("class_row_id", "class_row_hash", "class_own_hash"))
    found = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest))
    rows = docs.withColumn(own, F.xxhash64(text_of(text)))
    return (
        rows.join(
            found,
            F.col(doc_id).eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest)),
            "left_semi",
        )
        .dropDuplicates([doc_id, own])
        .drop(own)
    )
