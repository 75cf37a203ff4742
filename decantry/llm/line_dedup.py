"""Removal of lines that many documents have, decided by streaming over sorted hashes.

Each line long enough becomes a row of its key's hash (128 bits), its document and its
position. The rows are dealt by ranges of (hash, document, position), latest document
first, and stored that way; a task reads its range in order and needs to remember no
more than one document's lines. A hash with very many rows is spread over several
ranges. There are at most as many of those as ranges, and their documents are counted
beforehand.

The result is a bitmap per document, not text: bit i is 0 where line i goes. It ends
with the last line that goes, so documents that keep all have none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, UPPER, checkpointed, free_name, row_key, text_of

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def compress(dropped: list[int]) -> bytes:
    """The keep bitmap of a document that loses these lines."""
    keep = np.ones(max(dropped) + 1, np.uint8)
    keep[dropped] = 0
    return len(keep).to_bytes(8, "little") + zlib.compress(np.packbits(keep).tobytes())


def keep_flags(bitmap: bytes) -> np.ndarray:
    bits = np.frombuffer(zlib.decompress(bitmap[8:]), np.uint8)
    return np.unpackbits(bits, count=int.from_bytes(bitmap[:8], "little")).astype(bool)


def _line_rows(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """A row per line, of rows that have an id: only they can be the latest document."""
    keys = F.transform(lines_of(text_of(text)), line_key)
    lines = docs.filter(F.col(doc_id).isNotNull()).select(
        *row_key(doc_id, text), F.posexplode(keys).alias("line", "key")
    )
    return lines.filter(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text_hash",
        "line",
    )


def _shared_by_ranges(ranged: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Of each hash that lies in several ranges, the latest document and how many."""
    edges = (
        ranged.groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(F.struct("h1", "h2")).alias("first"), F.max(F.struct("h1", "h2")).alias("last"))
        .collect()
    )
    seen: set[tuple[int, int]] = set()
    shared: set[tuple[int, int]] = set()
    for row in edges:
        own = {tuple(row["first"]), tuple(row["last"])}
        shared |= own & seen
        seen |= own
    if not shared:
        return {}
    found = (
        ranged.filter(F.col("h1").isin(sorted({h for h, _ in shared})))
        .select("h1", "h2", "doc_id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("latest"), F.count("*").alias("documents"))
        .collect()
    )
    return {(r["h1"], r["h2"]): (r["latest"], r["documents"]) for r in found}


class Stream:
    """Which rows go, of rows that come in order in any number of batches.

    Between batches it knows the hash it is at, its latest document, the last document
    it saw, the number of documents up to the limit, and the rows that wait for it.
    """

    def __init__(self, limit: int, known: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.limit = limit
        self.known = known
        self.at: tuple[int, int] | None = None
        self.latest = self.previous = self.documents = 0
        self.waiting: list[np.ndarray] = []

    def __call__(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, rows: np.ndarray):
        """Those of ``rows`` that go, and waiting rows of earlier batches that go."""
        n = len(h1)
        new_hash = np.ones(n, bool)
        new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_hash.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        starts = np.flatnonzero(new_hash)
        ends = np.append(starts[1:], n)
        documents = np.add.reduceat(new_doc.astype(np.int64), starts)
        latest = doc[starts].copy()
        out = []

        first = (int(h1[0]), int(h2[0]))
        if first == self.at:
            documents[0] += self.documents - (int(doc[0]) == self.previous)
            latest[0] = self.latest
            if documents[0] >= self.limit:
                out += self.waiting
                self.waiting = []
        else:
            self.waiting = []
        for h, (last_doc, count) in self.known.items():
            lo = np.searchsorted(h1[starts], h[0])
            while lo < len(starts) and h1[starts[lo]] == h[0]:
                if h2[starts[lo]] == h[1]:
                    documents[lo], latest[lo] = count, last_doc
                lo += 1

        run = np.cumsum(new_hash) - 1
        later = doc != latest[run]
        out.append(rows[later & (documents[run] >= self.limit)])

        self.at = (int(h1[-1]), int(h2[-1]))
        self.latest, self.previous = int(latest[-1]), int(doc[-1])
        self.documents = min(int(documents[-1]), self.limit)
        if self.documents < self.limit:
            tail = slice(starts[-1], ends[-1])
            self.waiting.append(rows[tail][later[tail]])
        else:
            self.waiting = []
        return np.concatenate(out)


def line_keeps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_dropped`` and ``keep`` of rows that lose lines.

    A line is known by its key: white space stripped at both ends and A-Z in lower case.
    Keys of at least ``min_chars`` code points in at least ``min_documents`` documents
    lose all their lines except in the largest id that has them. Rows of one id are one
    document there, and get a bitmap each; repeated rows share theirs. A row with a NULL
    id loses nothing and does not count. NULL and empty texts have one empty line.
    """
    spark = docs.sparkSession
    rows = _line_rows(docs, doc_id, text, min_chars)
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc(), F.col("text_hash"), F.col("line")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order))
    known = _shared_by_ranges(ranged)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(min_documents, known)
        for batch in batches:
            if not len(batch):
                continue
            h1, h2, doc, text_hash, line = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            gone = stream(h1, h2, doc, np.column_stack([doc, text_hash, line]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gone[:, i]) for i in range(3)], names=["doc_id", "text_hash", "line"]
            )

    @F.pandas_udf("binary")
    def bitmap(dropped: pd.Series) -> pd.Series:
        return dropped.map(lambda x: compress(list(x)))

    gone = ranged.mapInArrow(work, "doc_id long, text_hash long, line long")
    return (
        gone.groupBy("doc_id", "text_hash")
        .agg(F.collect_set("line").alias("lines"))
        .select(
            "doc_id",
            "text_hash",
            F.size("lines").cast("long").alias("n_dropped"),
            bitmap("lines").alias("keep"),
        )
    )


def drop_lines(
    docs: DataFrame,
    keeps: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with the lines that stay, joined by a line feed, and two counts.

    The text of a row that loses nothing is as it was, NULL included.
    """
    key, digest, flags = (free_name(c, docs) for c in ("keep_id", "keep_hash", "keep_flags"))
    count = free_name("keep_count", docs)

    @F.pandas_udf("array<boolean>")
    def unpacked(bitmap: pd.Series) -> pd.Series:
        return bitmap.map(lambda x: None if x is None else keep_flags(x))

    joined = docs.join(
        keeps.select(
            F.col("doc_id").alias(key),
            F.col("text_hash").alias(digest),
            F.col("n_dropped").alias(count),
            F.col("keep").alias(flags),
        ),
        (F.col(doc_id) == F.col(key)) & (F.xxhash64(text_of(text)) == F.col(digest)),
        "left",
    ).withColumn(flags, unpacked(flags))
    lines = lines_of(text_of(text))
    left = F.array_join(
        F.filter(lines, lambda line, i: F.coalesce(F.get(F.col(flags), i), F.lit(True))), "\n"
    )
    return joined.withColumns(
        {
            n_lines: F.size(lines).cast("long"),
            n_dropped: F.coalesce(F.col(count), F.lit(0)).cast("long"),
            text: F.when(F.col(flags).isNull(), F.col(text)).otherwise(left),
        }
    ).drop(key, digest, flags, *([count] if count != n_dropped else []))
