"""Toxicity by two class-conditional Kneser-Ney models over the letters of words.

An n-gram is the last ``ORDER`` bytes of a word up to a place in it, lower-case, its
leading space included and nothing before that; so rare and inflected forms share what
their beginnings have in common. Both classes back off to one model of all learnt texts:
a Kneser-Ney model whose lower orders count the distinct n-grams that an ending has. A
class discounts each count by ``DISCOUNT`` and gives that mass to the shared model.

Counting and the joins that give each n-gram its log-likelihood ratio run over all
labelled rows, on Spark, and all ratios are kept in a stored table. Of these, scoring
broadcasts the most frequent one of each of ``SLOTS`` places. A place is marked where
others fell into it too; what a text needs of those is joined to it from the stored
table, so each n-gram has its own ratio however many there are.

Of an n-gram that neither class has seen, the likelihoods differ by the weight each
class gives to the shared model after that context. Where neither has seen the context,
it is shortened by a byte, down to none; lower orders of a class count distinct n-grams.

A document's score comes from length-normalised ratios: the mean per byte, and those of
its most telling words. A logistic model of these is fitted on a part of the labelled
rows that the counts leave out, on at most ``SAMPLE_ROWS`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosted_trees import labelled_sample
from .common import in_chunks, join_unique, mix64, stored, text_of

ORDER = 5
SHARED_DISCOUNT = 0.75
DISCOUNT = 0.75
SLOTS = 1 << 22
SAMPLE_ROWS = 20_000
FEATURES = 10
STEPS = 2 * ORDER
CLASSES = ("toxic", "ordinary")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all n-grams of the texts one after another, the places where words end,
    and how many of the codes belong to each text."""
    raws = [b" " + t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    sizes = np.array([len(r) for r in raws], np.int64)
    a = np.frombuffer(b"".join(raws), np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    index = np.arange(len(a))
    start = np.maximum.accumulate(np.where(space, index, 0))
    before = np.append(0, start[:-1])
    reach = np.where(space, index - before, index - start)  # a space ends the word before it
    letters = np.where(space, 32, a).astype(np.uint64)
    codes = letters.copy()
    for k in range(1, ORDER):
        shifted = np.zeros_like(codes)
        shifted[k:] = letters[:-k]
        codes |= np.where(reach >= k, shifted << np.uint64(8 * k), np.uint64(0))
    first = np.cumsum(np.append(0, sizes[:-1]))
    inside = np.ones(len(a), bool)
    inside[first] = False  # each text's leading space
    return codes[inside], np.flatnonzero(space[inside]), sizes - 1


def keys_of(codes: np.ndarray, step: int) -> np.ndarray:
    """What to look up: the n-gram, its context, the n-gram one byte shorter, and so on."""
    order = ORDER - step // 2
    ending = codes & np.uint64((1 << (8 * order)) - 1)
    return (ending >> np.uint64(8) if step % 2 else ending) | np.uint64(step << 8 * ORDER)


def slots_of(keys: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key, and a tag above 0 that tells it from all others there."""
    mixed = mix64(keys.astype(np.uint64))
    return (mixed % np.uint64(slots)).astype(np.int64), (mixed // np.uint64(slots)).astype(np.int64) + 1


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratios by slot; a tag of 0 is an empty slot, and a crowded one has
    more keys than the one that is here."""

    tag: np.ndarray
    ratio: np.ndarray
    crowded: np.ndarray

    def __reduce__(self):
        # What is sent has the filled places only.
        slot = np.flatnonzero(self.tag).astype(np.int32)
        return _filled, (len(self.tag), slot, self.tag[slot], self.ratio[slot], self.crowded[slot])

    def of(self, codes: np.ndarray, more: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        return self.walk(codes, more)[0]

    def walk(
        self, codes: np.ndarray, more: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ratio of each code by its first key that is here or in ``more`` (sorted
        keys, ratios), and the places and keys that this table can't tell."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        places, asked = [], []
        for step in range(STEPS):
            keys = keys_of(codes[todo], step)
            slot, tag = slots_of(keys, len(self.tag))
            known = self.tag[slot] == tag
            out[todo[known]] = self.ratio[slot[known]]
            unsure = np.flatnonzero(~known & self.crowded[slot])
            places.append(todo[unsure])
            asked.append(keys[unsure])
            if more is not None and len(more[0]) and len(unsure):
                at = np.minimum(np.searchsorted(more[0], keys[unsure]), len(more[0]) - 1)
                found = more[0][at] == keys[unsure]
                out[todo[unsure[found]]] = more[1][at[found]]
                known[unsure[found]] = True
            todo = todo[~known]
            if not len(todo):
                break
        return out, np.concatenate(places), np.concatenate(asked)


def _filled(
    slots: int, slot: np.ndarray, tag: np.ndarray, ratio: np.ndarray, crowded: np.ndarray
) -> Ratios:
    table = Ratios(np.zeros(slots, np.int64), np.zeros(slots, np.float32), np.zeros(slots, bool))
    table.tag[slot], table.ratio[slot], table.crowded[slot] = tag, ratio, crowded
    return table


def features(
    texts: list[str | None], table: Ratios, keys: pa.Array | None = None, ratios: pa.Array | None = None
) -> np.ndarray:
    """Length-normalised ratios of each text and of its most telling words. ``keys`` and
    ``ratios`` are lists per text of what the table does not have."""
    out = np.zeros((len(texts), FEATURES))
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size < 1 << 19):
            size += len(texts[last] or "")
            last += 1
        codes, ends, sizes = grams([t or "" for t in texts[first:last]])
        more = None
        if keys is not None:
            own_keys, at = np.unique(
                keys.slice(first, last - first).flatten().to_numpy(zero_copy_only=False).astype(np.uint64),
                return_index=True,
            )
            own_ratios = ratios.slice(first, last - first).flatten().to_numpy(zero_copy_only=False)
            more = own_keys, own_ratios[at]
        sums = np.append(0, np.cumsum(table.of(codes, more)))
        words = np.diff(np.append(0, sums[ends + 1]))
        text_ends = np.cumsum(sizes)
        word_ends = np.searchsorted(ends, text_ends)
        w0 = c0 = 0
        for row, (c1, w1) in enumerate(zip(text_ends, word_ends, strict=True), first):
            own = words[w0:w1]
            telling = np.sort(own[own > 0])[::-1]
            top = np.append(telling[:5], np.zeros(5))[:5]
            total = sums[c1] - sums[c0]
            out[row] = (
                total / (c1 - c0), total / np.sqrt(c1 - c0), top[0], top[1], top[:3].mean(),
                top.mean(), np.log1p((telling > 2).sum()), np.log1p((telling > 4).sum()),
                np.log1p(np.maximum(telling - 2, 0).sum()), np.log1p(len(own)),
            )
            w0, c0 = w1, c1
        first = last
    return out


def _counted(rows: DataFrame) -> DataFrame:
    """``code``, ``toxic`` and ``ordinary``: how often each class has each n-gram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            toxic = np.array(batch.column("label").to_pylist(), bool)
            for label in (False, True):
                own = [t for t, x in zip(texts, toxic, strict=True) if x == label]
                start = 0
                while start < len(own):
                    end, size = start, 0
                    while end < len(own) and (end == start or size < 1 << 20):
                        size += len(own[end])
                        end += 1
                    codes, n = np.unique(grams(own[start:end])[0], return_counts=True)
                    none = np.zeros_like(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes.astype(np.int64))]
                        + [pa.array(c) for c in ((n, none) if label else (none, n))],
                        names=["code", "toxic", "ordinary"],
                    )
                    start = end

    counts = rows.select("label", "text").mapInArrow(work, "code long, toxic long, ordinary long")
    return stored(
        counts.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def _levels(counted: DataFrame) -> dict[int, DataFrame]:
    """By order: ``code``, how often it is there, in all (``n``) and by class, and ``p``, the
    Kneser-Ney probability of a byte after the ones before it. Lower orders count the
    distinct n-grams that have the ending."""
    levels = {ORDER: counted.select("code", (F.col("toxic") + F.col("ordinary")).alias("n"), *CLASSES)}
    for order in range(ORDER - 1, 0, -1):
        ending = F.col("code").bitwiseAND((1 << (8 * order)) - 1)
        levels[order] = stored(
            levels[order + 1]
            .groupBy(ending.alias("code"))
            .agg(F.count("*").alias("n"), *(F.count_if(F.col(c) > 0).alias(c) for c in CLASSES))
        )
    for order in range(1, ORDER + 1):
        level = levels[order].withColumn("context", F.shiftrightunsigned("code", 8))
        totals = level.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        level = level.join(totals, "context")
        if order == 1:
            level = level.withColumn("lower", F.lit(1 / 256))
        else:
            ending = F.col("code").bitwiseAND((1 << (8 * order - 8)) - 1)
            level = level.withColumn("ending", ending).join(
                levels[order - 1].select(F.col("code").alias("ending"), F.col("p").alias("lower")), "ending"
            )
        own = F.greatest(F.col("n") - SHARED_DISCOUNT, F.lit(0.0))
        levels[order] = stored(
            level.select(
                "code",
                "n",
                *CLASSES,
                ((own + SHARED_DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("total")).alias("p"),
            )
        )
    return levels


def _ratios(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``code``, ``n`` and ``ratio``, the log of the toxic over the ordinary likelihood, of
    the n-grams of one order, and the same of their contexts for what was not seen there."""
    counted = level.withColumn("context", F.shiftrightunsigned("code", 8))
    sums = {
        f"{c}_{kind}": F.sum(F.least(F.col(c), F.lit(DISCOUNT)) if kind == "off" else F.col(c))
        for c in CLASSES
        for kind in ("all", "off")
    }
    contexts = counted.groupBy("context").agg(
        F.sum("n").alias("context_n"), *(v.alias(k) for k, v in sums.items())
    )

    def weight(c: str) -> Column:
        known = F.col(f"{c}_all") > 0
        return F.when(known, F.col(f"{c}_off") / F.col(f"{c}_all")).otherwise(F.lit(1.0))

    def likelihood(c: str) -> Column:
        own = F.greatest(F.col(c) - DISCOUNT, F.lit(0)) + F.col(f"{c}_off") * F.col("p")
        return F.when(F.col(f"{c}_all") > 0, own / F.col(f"{c}_all")).otherwise(F.col("p"))

    grams = counted.join(contexts, "context").select(
        "code", "n", F.ln(likelihood("toxic") / likelihood("ordinary")).alias("ratio")
    )
    unseen = contexts.select(
        F.col("context").alias("code"),
        F.col("context_n").alias("n"),
        F.ln(weight("toxic") / weight("ordinary")).alias("ratio"),
    )
    return grams, unseen


def ratio_rows(rows: DataFrame) -> DataFrame:
    """``code``, ``n`` and ``ratio`` of the n-grams of the highest order."""
    return _ratios(_levels(_counted(rows))[ORDER])[0]


def all_ratios(rows: DataFrame) -> DataFrame:
    """``code``, ``n`` and ``ratio`` of n-grams and contexts of all orders, by ``keys_of``."""
    levels = _levels(_counted(rows))
    every = None
    for step in range(STEPS):
        own = _ratios(levels[ORDER - step // 2])[step % 2]
        own = own.withColumn("code", F.col("code").bitwiseOR(step << 8 * ORDER))
        every = own if every is None else every.union(own)
    return stored(every.withColumn("ratio", F.col("ratio").cast("float")))


def ratio_table(ratios: DataFrame, slots: int = SLOTS) -> Ratios:
    """The most frequent key of each of ``slots`` places, which is what comes to the driver."""

    @F.pandas_udf("slot long, tag long")
    def place(codes: pd.Series) -> pd.DataFrame:
        slot, tag = slots_of(codes.to_numpy(), slots)
        return pd.DataFrame({"slot": slot, "tag": tag})

    best = (
        ratios.withColumn("place", place("code"))
        .groupBy("place.slot")
        .agg(
            F.max(F.struct("n", "code", "place.tag", "ratio")).alias("best"),
            (F.count("*") > 1).alias("crowded"),
        )
        .select(
            "slot",
            F.col("best.tag").alias("tag"),
            F.col("best.ratio").cast("float").alias("ratio"),
            "crowded",
        )
        .toArrow()
    )
    return _filled(slots, *(best.column(c).to_numpy() for c in ("slot", "tag", "ratio", "crowded")))


def _with_rest(rows: DataFrame, shared: Broadcast, ratios: DataFrame) -> DataFrame:
    """``rows`` with ``keys`` and ``ratios`` that their ``text`` needs besides the broadcast
    table; NULL where there are none."""
    hashed = F.xxhash64(text_of("text")).alias("text_hash")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes = batch.column("text").to_pylist(), batch.column("text_hash").to_numpy()
            for first, last in in_chunks(texts):
                codes, _, sizes = grams([t or "" for t in texts[first:last]])
                _, at, keys = shared.value.walk(codes)
                pairs = np.unique(
                    np.column_stack(
                        [np.searchsorted(np.cumsum(sizes), at, side="right"), keys.astype(np.int64)]
                    ),
                    axis=0,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[first:last][pairs[:, 0]]), pa.array(pairs[:, 1])],
                    names=["text_hash", "code"],
                )

    if not shared.value.crowded.any():
        none = F.lit(None)
        return rows.select(
            "*", none.cast("array<long>").alias("keys"), none.cast("array<float>").alias("ratios")
        )
    asked = rows.select(hashed, "text").mapInArrow(ask, "text_hash long, code long").distinct()
    # At every size alike: the texts are shuffled once, by their hash.
    found = (
        join_unique(asked, ratios.select("code", "ratio"), "code")
        .groupBy("text_hash")
        .agg(F.collect_list(F.struct("code", "ratio")).alias("found"))
        .select("text_hash", F.col("found.code").alias("keys"), F.col("found.ratio").alias("ratios"))
    )
    return join_unique(rows.select("*", hashed), found, "text_hash", "left").drop("text_hash")


@dataclass(frozen=True)
class Model:
    table: Ratios | None
    shared: Broadcast | None
    ratios: DataFrame | None
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([(x - self.middle) / self.spread, np.ones(len(x))]) @ self.weights
        return 1 / (1 + np.exp(-z))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre and spread of the features, and weights with the constant last. A constant
    near the share of label 1 comes out where the rows do not tell more."""
    middle = x.mean(0) if len(x) else np.zeros(x.shape[1])
    spread = (x.std(0) if len(x) else np.zeros(x.shape[1])) + 1e-9
    z = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    # Two pseudo-rows, one of each label, keep the constant finite.
    z = np.vstack([z, np.eye(z.shape[1])[[-1, -1]]])
    y = np.append(y, [0, 1])
    weights = np.zeros(z.shape[1])
    shrink = np.full(z.shape[1], penalty)
    shrink[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        step = np.linalg.solve(
            (z.T * (p * (1 - p))) @ z + np.diag(shrink), z.T @ (y - p) - shrink * weights
        )
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return middle, spread, weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    slots: int = SLOTS,
) -> Model:
    """Fit both models and the score. ``learn_from`` is a condition on ``doc_id``.

    NULL ids and labels teach nothing; of several labels of an id the largest counts;
    rows that share an id are learnt from each. A quarter of the ids, by a hash, and at
    most ``sample_rows`` of them are left for the score; all others are counted.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    for_score = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg((F.max(label) == 1).alias("label"))
        .filter(learn_from)
    )
    sample = stored(labelled_sample(labels, label, learn_from & for_score, sample_rows))
    left_out = F.broadcast(sample.select("doc_id"))  # at most sample_rows ids
    known = known.join(left_out, "doc_id", "left_anti")
    learnt = rows.filter(learn_from).join(known.hint("shuffle_hash"), "doc_id")
    ratios = all_ratios(learnt)
    table = ratio_table(ratios, slots)
    shared = spark.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            x = features(texts, shared.value, batch.column("keys"), batch.column("ratios"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )

    sampled = rows.join(F.broadcast(sample), "doc_id").select(  # at most sample_rows ids and labels
        "doc_id", (F.col("label") == 1).cast("double").alias("label"), "text"
    )
    seen = (
        _with_rest(sampled, shared, ratios)
        .mapInArrow(work, f"doc_id {kind}, label double, x array<double>")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("x").alias("x"))
        .orderBy("doc_id")
        .toArrow()
    )
    x = np.array(seen.column("x").to_pylist(), np.float64).reshape(-1, FEATURES)
    return Model(table, shared, ratios, *logistic(x, seen.column("label").to_numpy()))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of each row; NULL texts score as empty ones."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = model.shared
    fit = replace(model, table=None, shared=None, ratios=None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            x = features(texts, shared.value, batch.column("keys"), batch.column("ratios"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fit.score(x), pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_rest(rows, shared, model.ratios).mapInArrow(work, f"doc_id {kind}, score double")
