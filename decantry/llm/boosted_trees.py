"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are cut into quantile bins; each tree level picks per node the split of the
largest gain from histograms of gradients. Trees are complete, so a model is three
arrays, and scoring a batch is a few numpy steps per level for all rows at once.

The trees are fitted on at most ``SAMPLE_ROWS`` labelled rows, chosen by a hash of the
id. Everything else covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
DEPTH, TREES, BINS = 4, 80, 64
RATE, LAMBDA, MIN_WEIGHT = 0.15, 1.0, 4.0

_MARKS = b"!?.,;:|#*$%&<>@/\\_-+=()[]{}\"'0123456789"
FEATURES = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "distinct_words",
    "top_word", "longest_repeat", "lines_per_word", "repeated_lines", "upper", "accented",
    "spaces", "digits", "symbols", "entropy", "loud_lines", "marked_lines", "barred_lines",
    "words_with_marks", "repeated_pairs",
    *(f"mark_{chr(b)}" for b in _MARKS[:30]),
]
_MARK_BYTES = np.frombuffer(_MARKS[:30], np.uint8)
_SYMBOL_BYTES = np.frombuffer(b"#*$%&|<>", np.uint8)
_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def statistics(text: str) -> list[float]:
    """The statistics of one text, each a rate or a logarithm; empty texts have zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    words, lines = raw.split(), raw.split(b"\n")
    m = max(len(words), 1)
    lengths = np.array([len(w) for w in words] or [0])
    of = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    longest = run = 1 if words else 0
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    share = counts[counts > 0] / n
    full = [x for x in lines if x.strip()]
    loud = sum(len(x) > 3 and x.upper() == x and x.lower() != x for x in full)
    marked = sum(len(_SYMBOLS.findall(x)) * 20 > len(x) for x in full)
    barred = sum(x.count(b" | ") > 1 for x in full)
    at_end = sum(w[-1] in b"!#*$%&|<>" for w in words)
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        len(of) / m,
        max(of.values(), default=0) / m,
        float(np.log1p(longest)),
        len(full) / m,
        1 - len(set(full)) / max(len(full), 1),
        upper / max(upper + lower, 1),
        int(counts[128:].sum()) / n,
        int(counts[[9, 10, 11, 12, 13, 32]].sum()) / n,
        int(counts[48:58].sum()) / n,
        int(counts[_SYMBOL_BYTES].sum()) / n,
        float(-(share * np.log2(share)).sum()) + 0.0,
        loud / max(len(full), 1),
        marked / max(len(full), 1),
        barred / max(len(full), 1),
        at_end / m,
        1 - len(pairs) / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
        *(counts[_MARK_BYTES] / n).tolist(),
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """Complete trees: node k of a tree has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; larger values go right
    leaf: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node[0] < len(feature) if len(node) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost on the logistic loss. Without rows of both labels, the score is a constant."""
    inner = 2**DEPTH - 1
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    model = ([], [], [])
    total = np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature = np.zeros(inner, np.int64)
        threshold = np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            local = node - base
            best = np.full(width, 1e-9)
            split = np.full(width, BINS)
            for f, bins in enumerate(binned):
                at = local * BINS + bins
                g = np.bincount(at, gradient, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(at, weight, width * BINS).reshape(width, BINS).cumsum(1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + LAMBDA) + rest_g**2 / (rest_h + LAMBDA)
                gain -= g[:, -1:] ** 2 / (h[:, -1:] + LAMBDA)
                gain[(h < MIN_WEIGHT) | (rest_h < MIN_WEIGHT)] = 0
                gain[:, len(cuts[f]) :] = 0
                k = gain.argmax(1)
                gained = gain[np.arange(width), k]
                better = gained > best
                best[better], split[better] = gained[better], k[better]
                feature[base : base + width][better] = f
                threshold[base : base + width][better] = cuts[f][np.minimum(k[better], len(cuts[f]) - 1)]
            own = binned[feature[node], np.arange(len(y))]
            node = 2 * node + 1 + (own > split[local])
        at_leaf = node - inner
        g = np.bincount(at_leaf, gradient, inner + 1)
        h = np.bincount(at_leaf, weight, inner + 1)
        leaf = RATE * g / (h + LAMBDA)
        total += leaf[at_leaf]
        for part, made in zip(model, (feature, threshold, leaf), strict=True):
            part.append(made)
    return Trees(*(np.array(part) for part in model), start)


def labelled_sample(labels: DataFrame, label: str, learn_from: Column, rows: int) -> DataFrame:
    """At most ``rows`` ids with their label, by a hash of the id.

    NULL ids and labels are left out; where an id has several labels, the largest counts.
    """
    return (
        labels.filter(learn_from & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Trees:
    """Fit on a bounded sample. ``learn_from`` is a condition on the labels' ``doc_id``."""
    sample = labelled_sample(labels, label, learn_from, sample_rows)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(list(found), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )

    known = (
        rows.join(F.broadcast(sample), "doc_id")  # at most sample_rows ids and labels
        .select("doc_id", F.col("label").cast("double").alias("label"), "text")
        .mapInArrow(work, f"doc_id {kind}, label double, x array<double>")
        .groupBy("doc_id")  # rows that share an id count once
        .agg(F.max("label").alias("label"), F.min("x").alias("x"))
        .orderBy("doc_id")
        .toArrow()
    )
    x = np.array(known.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, known.column("label").to_numpy())


def score(docs: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of each row; NULL texts score as empty ones."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(matrix(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, f"doc_id {kind}, score double")
