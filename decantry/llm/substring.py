"""Removal of repeated passages, by super-k-mers of word windows.

A window is ``window`` consecutive words of a document. Its minimiser is the smallest
hash of its runs of ``run`` words, the first one on a tie; equal windows have equal
minimisers at equal places. Consecutive windows that share their minimiser's place are
one super-k-mer: a stretch of at most ``2 * window - run`` words.

1. Every super-k-mer's minimiser, document and place are noted, without text. Of documents
   with the same words the smallest stands for all: the others lose all their windows.
   Only super-k-mers whose minimiser is in several other documents can hold repeats.
2. These travel as one packed string each to the bucket of their minimiser. Equal strings
   become one, with their smallest document, before and after they travel.
3. A bucket sorts its windows by hash (128 bits) and document: the first of equal ones
   is in the smallest document that has them.
4. Each place asks its string which windows a smaller document has, and each document
   loses the words that these cover.

A minimiser at more places than ``hot`` sends each window to the bucket of its own hash
instead, as a string of one window. Equal windows are one row there, so that no bucket
grows with the number of copies or of variants around a passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_unique, mix64, stored, text_of

WINDOW = 50
RUN = 8
HOT = 10_000


def hash_words(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each word, as two rows."""
    digest = b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in words])
    return np.frombuffer(digest, np.uint64).reshape(-1, 2).T


class WordHashes:
    """Hashes of words, each computed once; forgets all when it has too many."""

    def __init__(self, most: int = 500_000) -> None:
        self.most = most
        self.known: dict[bytes, bytes] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        for w in {*words}.difference(self.known):
            self.known[w] = hashlib.blake2b(w, digest_size=16).digest()
        return np.frombuffer(b"".join([self.known[w] for w in words]), np.uint64).reshape(-1, 2).T


_SHARED = WordHashes()
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64, from 0 on."""
    up, down = np.full(size, _FACTOR), np.full(size, np.uint64(pow(int(_FACTOR), -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, for each row of word hashes.

    A run's polynomial is the difference of two sums from the start, moved to the run's
    own place by a power of the factor; all of it is modulo 2^64.
    """
    size = words.shape[1]
    n = size - length + 1
    if n <= 0:
        return np.zeros((words.shape[0], 0), np.uint64)
    # Rounded up, so that few sizes are ever made.
    up, down = _powers(1 << max(size, 1024).bit_length())
    sums = np.zeros((words.shape[0], size + 1), np.uint64)
    np.cumsum(words * down[:size], axis=1, out=sums[:, 1:])
    return mix64((sums[:, length:] - sums[:, :n]) * up[length - 1 : length - 1 + n])


def smallest_place(values: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` consecutive values, the place of the first smallest one."""
    n = len(values) - width + 1
    place = np.arange(len(values))
    least = values
    done = 1
    while done < width:  # double the stretch that each place looks over
        step = min(done, width - done)
        left, right = least[: len(least) - step], least[step:]
        later = right < left
        place = np.where(later, place[step:], place[: len(place) - step])
        least = np.where(later, right, left)
        done += step
    return place[:n]


def super_kmers(words: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer in turn."""
    values = rolling(words[:1], run)[0]
    place = smallest_place(values, window - run + 1)
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    counts = np.diff(np.append(starts, len(place)))
    return values[place[starts]].astype(np.int64), starts, counts


def _bytes_of(texts: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in texts.cast(pa.binary()))


def _noted(rows: DataFrame, window: int, run: int) -> DataFrame:
    """A row per row with windows: the hash of all its words, and its super-k-mers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, same, minimisers, starts = [], [], [], []
            for i, raw in enumerate(_bytes_of(batch.column("text"))):
                words = (raw or b"").split()
                if len(words) < window:
                    continue
                found, first, _ = super_kmers(_SHARED(words), window, run)
                at.append(i)
                same.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                minimisers.append(found)
                starts.append(np.append(first, len(words) - window + 1).astype(np.int32))
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("text_hash").take(taken),
                    pa.array(same, pa.binary()),
                    pa.array(minimisers, pa.list_(pa.int64())),
                    pa.array(starts, pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_hash", "same", "minimisers", "starts"],
            )

    return rows.mapInArrow(
        work,
        "doc_id long, text_hash long, same binary, minimisers array<long>, starts array<int>",
    )


def _strings_of(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Row, bucket, first window and packed string of all that travels of a batch."""
    places = batch.column("places").to_pylist()
    for i, row in enumerate(batch.column("row").to_pylist()):
        words = row["text"].encode().split()
        for place in places[i]:
            first, n = place["start"], place["n_windows"]
            if place["hot"]:
                own = rolling(_SHARED(words[first : first + n + window - 1]), window)[0]
                for k, h in enumerate(own.astype(np.int64).tolist()):
                    yield i, h, first + k, b" ".join(words[first + k : first + k + window])
            else:
                yield i, place["minimiser"], first, b" ".join(words[first : first + n + window - 1])


def _id_of(bucket: int, packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16, salt=bucket.to_bytes(8, "little", signed=True)).digest()


def _travelling(rows: DataFrame, window: int, kept: int = 100_000) -> DataFrame:
    """Distinct strings with their smallest document, as far as a task has room to tell."""

    def flush(known: dict[tuple[int, bytes], int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([b for b, _ in known], pa.int64()),
                pa.array([p for _, p in known], pa.binary()),
                pa.array(list(known.values()), pa.int64()),
            ],
            names=["bucket", "packed", "least"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, bucket, _, packed in _strings_of(batch, window):
                key = (bucket, packed)
                known[key] = min(ids[i], known.get(key, ids[i]))
                if len(known) >= kept:
                    yield flush(known)
                    known = {}
        yield flush(known)

    return rows.mapInArrow(work, "bucket long, packed binary, least long")


def _asking(rows: DataFrame, window: int) -> DataFrame:
    """The place of each string that travels, with the string's id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids, start = [], [], []
            for i, bucket, first, packed in _strings_of(batch, window):
                row.append(i)
                ids.append(_id_of(bucket, packed))
                start.append(first)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.binary()),
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(start, pa.int32()),
                ],
                names=["id", "doc_id", "text_hash", "start"],
            )

    return rows.mapInArrow(work, "id binary, doc_id long, text_hash long, start int")


def first_documents(packed: list[bytes], documents: np.ndarray, window: int) -> list[np.ndarray]:
    """For each string, the smallest document of each of its windows in the bucket."""
    if len(packed) == 1:
        return [np.full(packed[0].count(b" ") + 2 - window, documents[0])]
    words = [p.split(b" ") for p in packed]
    counts = np.array([len(w) for w in words])
    sizes = counts - window + 1
    # Windows of all strings at once, without those that reach into the next one.
    h1, h2 = rolling(_SHARED([w for ws in words for w in ws]), window)
    first = np.cumsum(counts) - counts
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    h1, h2 = h1[inside], h2[inside]
    owner = np.repeat(documents, sizes)
    order = np.lexsort((owner, h2, h1))
    a, b = h1[order], h2[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    least = np.empty_like(owner)
    least[order] = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return np.split(least, np.cumsum(sizes)[:-1])


def _counted(strings: DataFrame, window: int) -> DataFrame:
    """Of each string its id and, per window, the smallest document, bucket by bucket."""

    def finish(bucket: int, least: dict[bytes, int]) -> pa.RecordBatch:
        packed = list(least)
        found = first_documents(packed, np.array(list(least.values())), window)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([_id_of(bucket, p) for p in packed], pa.binary()),
                pa.array([x.tolist() for x in found], pa.list_(pa.int64())),
            ],
            names=["id", "firsts"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, least = None, {}
        for batch in batches:
            for bucket, packed, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if least and bucket != at:
                    yield finish(at, least)
                    least = {}
                at = bucket
                least[packed] = min(doc, least.get(packed, doc))
        if least:
            yield finish(at, least)

    dealt = strings.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(work, "id binary, firsts array<long>")


def _keyed_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All columns as ``row``, next to the key. Both joins with texts read this frame alike,
    so that Spark shuffles the texts once for the two of them."""
    columns = [
        F.col(f"`{c}`").alias("text" if c == text else c)
        for c in docs.columns
        if c == text or c.lower() != "text"
    ]
    return docs.select(
        F.struct(*columns).alias("row"),
        F.col(doc_id).cast("long").alias("row_id"),
        F.xxhash64(text_of(text)).alias("row_hash"),
    )


def repeated_windows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    run: int = RUN,
    hot: int = HOT,
) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``starts``: the windows a smaller document has.

    Rows with repeated windows only; ``starts`` is NULL where all windows are repeated.
    Rows of one id count as one document, and repeated rows are the same there. Rows with
    a NULL id take no part; NULL texts and texts of fewer than ``window`` words have no
    windows.
    """
    noted = stored(
        _noted(
            docs.filter(F.col(doc_id).isNotNull()).select(
                F.col(doc_id).cast("long").alias("doc_id"),
                F.xxhash64(text_of(text)).alias("text_hash"),
                F.col(text).alias("text"),
            ),
            window,
            run,
        )
    )
    leaders = noted.groupBy("same").agg(F.min("doc_id").alias("leader"))
    marked = join_unique(noted, leaders, "same")
    copies = marked.filter(F.col("doc_id") > F.col("leader")).select(
        "doc_id", "text_hash", F.lit(None).cast("array<int>").alias("starts")
    )
    places = (
        marked.filter(F.col("doc_id") == F.col("leader"))
        .select("doc_id", "text_hash", "starts", F.posexplode("minimisers").alias("k", "minimiser"))
        .select(
            "minimiser",
            "doc_id",
            "text_hash",
            F.get("starts", F.col("k")).alias("start"),
            (F.get("starts", F.col("k") + 1) - F.get("starts", F.col("k"))).alias("n_windows"),
        )
    )
    shared = (
        places.groupBy("minimiser")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("doc_id").alias("most"),
            F.count("*").alias("places"),
        )
        .filter("least < most")
        .select("minimiser", (F.col("places") > hot).alias("hot"))
    )
    wanted = stored(
        join_unique(places, shared, "minimiser")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "n_windows", "minimiser", "hot")).alias("places"))
    )
    with_text = (
        _keyed_rows(docs, doc_id, text)
        .join(
            wanted,
            F.col("row_id").eqNullSafe(F.col("doc_id"))
            & F.col("row_hash").eqNullSafe(F.col("text_hash")),
        )
        .select("doc_id", "text_hash", "row", "places")
    )
    counted = _counted(_travelling(with_text, window), window)
    found = (
        _asking(with_text, window)
        .join(counted, "id")
        .select(
            "doc_id",
            "text_hash",
            F.filter(
                F.transform(
                    "firsts",
                    lambda d, i: F.when(d < F.col("doc_id"), F.col("start") + i),
                ),
                lambda i: i.isNotNull(),
            ).alias("starts"),
        )
        .filter(F.size("starts") > 0)
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))
    )
    return found.unionByName(copies.distinct())


def cover(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Which words the windows cover."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + window, n_words), -1)
    return change[:n_words].cumsum() > 0


def drop_windows(
    docs: DataFrame,
    windows: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    n_removed: str = "n_removed",
) -> DataFrame:
    """``docs`` without the words that ``windows`` cover, and how many these are.

    The words that stay are joined by one space; the text of a row that loses none is
    as it was, NULL included.
    """
    @F.pandas_udf("text string, n long")
    def without(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        kept, count = [], []
        for body, at in zip(texts, found, strict=True):
            if body is None:
                kept.append(None)
                count.append(0)
                continue
            words = body.encode().split()
            every = range(len(words) - window + 1)
            gone = cover(np.asarray(every if at is None else at), len(words), window)
            kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode())
            count.append(int(gone.sum()))
        return pd.DataFrame({"text": kept, "n": count})

    joined = _keyed_rows(docs, doc_id, text).join(
        windows.select(
            F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "starts"
        ),
        F.col("row_id").eqNullSafe(F.col("gone_id"))
        & F.col("row_hash").eqNullSafe(F.col("gone_hash")),
        "left",
    )
    # Only texts that lose words go through Python.
    hit = F.col("gone_id").isNotNull()
    done = joined.select(
        "row", "starts", F.when(hit, F.col("row.text")).alias("body")
    ).withColumn("left", without("body", "starts"))
    return done.select(
        *(
            F.coalesce("left.text", "row.text").alias(c)
            if c == text
            else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
            if c != n_removed
        ),
        F.col("left.n").alias(n_removed),
    )
