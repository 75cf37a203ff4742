"""Document fingerprints from prefix polynomial hashes.

For a text of code points c, ``H[i]`` is the sum of ``c[j] * base**j`` over all j < i,
modulo a prime. Two such arrays answer whether any two spans are equal, and a binary
search over them finds the longest common extension of two positions.

A fingerprint holds the length, the hash of the whole text by two primes, the prefix
hashes at up to 32 evenly spaced places (a power of two apart), and the 64 smallest
mixed hashes of all spans of 12 code points. The likeness of two fingerprints is the
larger of the length of their longest common beginning, found by binary search over the
places that both have, as a share of the longer text; and the estimated Jaccard
likeness of their spans. It is 1 for equal fingerprints only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_of

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 1_664_525_017)
SPAN = 12
PLACES = 32
SMALLEST = 64


class _Powers:
    """Powers of the base and of its inverse, grown to the longest text so far."""

    def __init__(self, prime: int, base: int) -> None:
        self.prime = np.uint64(prime)
        self.up = self._grow(np.ones(1, np.uint64), base % prime)
        self.base, self.inverse = base % prime, pow(base, -1, prime)
        self.down = self._grow(np.ones(1, np.uint64), self.inverse)

    def _grow(self, known: np.ndarray, base: int) -> np.ndarray:
        step = np.uint64(pow(base, len(known), int(self.prime)))
        return np.concatenate([known, known * step % self.prime])

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            self.up, self.down = self._grow(self.up, self.base), self._grow(self.down, self.inverse)


_POWERS = tuple(_Powers(p, b) for p, b in zip(PRIMES, BASES, strict=True))


class PrefixHashes:
    """Prefix hashes of one text, by each of the primes."""

    def __init__(self, text: str) -> None:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.n = len(points)
        self.sums = []
        for powers in _POWERS:
            powers.reach(self.n)
            terms = (points + np.uint64(1)) * powers.up[: self.n] % powers.prime
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums % powers.prime)

    def span(self, start: int, length: int) -> tuple[int, int]:
        """The hash of a span; the same for equal spans anywhere."""
        return tuple(
            (int(h[start + length]) - int(h[start])) * int(w.down[start]) % int(w.prime)
            for h, w in zip(self.sums, _POWERS, strict=True)
        )

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of a length by the first prime; of the whole text if shorter."""
        length = min(length, self.n)
        h, w = self.sums[0], _POWERS[0]
        found = (h[length:] + w.prime - h[: self.n + 1 - length]) % w.prime
        return found * w.down[: len(found)] % w.prime


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """The length of the longest common beginning of ``a`` from i and ``b`` from j."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, middle) == b.span(j, middle):
            low = middle
        else:
            high = middle - 1
    return low


@dataclass(frozen=True)
class Fingerprint:
    n: int
    whole: int
    places: tuple[int, ...]
    smallest: tuple[int, ...]

    @staticmethod
    def of(text: str) -> Fingerprint:
        hashes = PrefixHashes(text)
        first, second = (int(h[-1]) for h in hashes.sums)
        mixed = mix64(hashes.spans(SPAN)) >> np.uint64(32)
        if len(mixed) > 4 * SMALLEST:  # then few are worth sorting
            least = np.partition(mixed, 2 * SMALLEST)[: 2 * SMALLEST]
            mixed = least if len(np.unique(least)) >= SMALLEST else mixed
        return Fingerprint(
            hashes.n,
            first << 31 | second,
            tuple(hashes.sums[0][:: step_of(hashes.n)][1:].tolist()),
            tuple(np.unique(mixed)[:SMALLEST].tolist()),
        )

    def __str__(self) -> str:
        places = "".join(f"{x:08x}" for x in self.places)
        smallest = "".join(f"{x:08x}" for x in self.smallest)
        return f"{self.n:x}.{self.whole:016x}.{places}.{smallest}"

    @staticmethod
    def read(text: str) -> Fingerprint:
        n, whole, places, smallest = text.split(".")
        parts = lambda x: tuple(int(x[i : i + 8], 16) for i in range(0, len(x), 8))
        return Fingerprint(int(n, 16), int(whole, 16), parts(places), parts(smallest))


def step_of(n: int) -> int:
    step = 1
    while n > step * PLACES:
        step *= 2
    return step


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if a == b:
        return 1.0
    step = max(step_of(a.n), step_of(b.n))
    mine = a.places[step // step_of(a.n) - 1 :: step // step_of(a.n)]
    theirs = b.places[step // step_of(b.n) - 1 :: step // step_of(b.n)]
    low, high = 0, min(len(mine), len(theirs))
    while low < high:  # prefixes that agree at a place agree at all places before it
        middle = (low + high + 1) // 2
        if mine[middle - 1] == theirs[middle - 1]:
            low = middle
        else:
            high = middle - 1
    begun = low * step / max(a.n, b.n, 1)
    least = sorted({*a.smallest, *b.smallest})[:SMALLEST]
    both = {*a.smallest} & {*b.smallest}
    alike = sum(x in both for x in least) / max(len(least), 1)
    return min(max(begun, alike), 1 - 1e-9)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars`` and ``fingerprint`` of each row, in one pass without a shuffle.

    A NULL text counts as empty, and so has the fingerprint of an empty text.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Fingerprint.of(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.n for x in found], pa.int64()),
                    pa.array([str(x) for x in found], pa.string()),
                ],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, f"doc_id {kind}, n_chars long, fingerprint string")


def with_follower(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows dealt into ranges of ids, each range in one partition in the order of ids.

    The first row of each range is also the last row of the range before it, marked
    ``after``; that of the first range follows the last one. So every row's follower
    is in its own partition, and no more than one id per range goes to the driver.
    Rows of one id are ordered by text; a NULL id comes first.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_of(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("place"),
    )
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [F.lit(i / ranges) for i in range(1, ranges)] or [F.lit(0.5)]
    found = rows.agg(
        F.min("place").alias("least"),
        F.percentile_approx("place", F.array(*shares), max(10_000, 10 * ranges)).alias("cuts"),
    ).first()
    firsts = sorted({found["least"], *found["cuts"]}) if found["cuts"] else [0]
    last = len(firsts) - 1

    firsts_array = F.array(*(F.lit(x) for x in firsts))
    steps = [1 << k for k in reversed(range(last.bit_length()))]

    def own(place: Column) -> Column:
        """The last range that begins at or before a place, by binary search."""
        if not last:
            return F.lit(0)
        return F.aggregate(
            F.array(*(F.lit(x) for x in steps)),
            F.lit(0),
            lambda at, step: F.when(
                (at + step <= last)
                & (F.element_at(firsts_array, F.least(at + step, F.lit(last)) + 1) <= place),
                at + step,
            ).otherwise(at),
        )

    # Rows at a range's first id go to the range before as well.
    at = F.col("range")
    before = F.when(at == 0, last).otherwise(at - 1)
    return (
        rows.withColumn("range", own(F.col("place")))
        .withColumn(
            "copy",
            F.explode(
                F.when(
                    F.element_at(firsts_array, at + 1) == F.col("place"),
                    F.array(
                        F.struct(at.alias("range"), F.lit(False).alias("after")),
                        F.struct(before.alias("range"), F.lit(True).alias("after")),
                    ),
                ).otherwise(
                    F.array(F.struct(at.alias("range"), F.lit(False).alias("after")))
                )
            ),
        )
        .select("doc_id", "text", "place", "copy.*")
        .repartitionById(len(firsts), F.col("range"))
        .sortWithinPartitions("after", "place", "text")
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the fingerprints of its text and of the edited text, and their likeness.

    A NULL text counts as empty. A document alone is its own follower. An empty table
    gives no rows. Other columns are left out.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose follower comes next
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "after")]
            for key, body, after in zip(*columns, strict=True):
                if waiting is None and after:
                    continue  # further rows of the id that follows
                print_of = Fingerprint.of(body)
                if waiting is not None:
                    last_key, last_body, last_print = waiting
                    changed = edited(last_body, body)
                    changed_print = Fingerprint.of(changed)
                    out.append(
                        (
                            last_key,
                            last_print.n,
                            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            str(last_print),
                            str(changed_print),
                            likeness(last_print, changed_print),
                            likeness(last_print, print_of),
                        )
                    )
                waiting = None if after else (key, body, print_of)
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, t)
                    for c, t in zip(
                        columns,
                        [batch.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2],
                        strict=True,
                    )
                ],
                names=names,
            )

    return with_follower(docs, doc_id, text).mapInArrow(
        work,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
