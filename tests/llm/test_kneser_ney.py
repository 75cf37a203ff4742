import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from decantry.llm import kneser_ney as K
from helpers import docs
from pyspark.sql import functions as F


def grams(text):
    """The n-grams of a text: bytes of a word up to each place, at most ORDER of them."""
    out = []
    for word in text.lower().encode().replace(b"\n", b" ").replace(b"\t", b" ").split(b" "):
        full = b" " + word + b" "
        for end in range(2, len(full) + 1):
            out.append(full[max(0, end - K.ORDER) : end].rjust(K.ORDER, b"\0"))
    return out


def code(gram):
    return int.from_bytes(gram, "big")


def brute_ratios(rows):
    toxic, ordinary = Counter(), Counter()
    for label, text in rows:
        (toxic if label else ordinary).update(map(code, grams(text)))
    both = toxic + ordinary
    levels = {K.ORDER: dict(both)}
    for order in range(K.ORDER - 1, 0, -1):
        levels[order] = Counter(c % 256**order for c in levels[order + 1])
    p = {}
    for order in range(1, K.ORDER + 1):
        total, kinds = Counter(), Counter()
        for c, n in levels[order].items():
            total[c >> 8] += n
            kinds[c >> 8] += 1
        p = {
            c: (
                max(n - K.SHARED_DISCOUNT, 0)
                + K.SHARED_DISCOUNT * kinds[c >> 8] * (1 / 256 if order == 1 else p[c % 256 ** (order - 1)])
            )
            / total[c >> 8]
            for c, n in levels[order].items()
        }

    def likelihood(counts):
        total, off = Counter(), Counter()
        for c, n in counts.items():
            total[c >> 8] += n
            off[c >> 8] += min(n, K.DISCOUNT)
        return {
            c: (max(counts[c] - K.DISCOUNT, 0) + off[c >> 8] * p[c]) / total[c >> 8] if total[c >> 8] else p[c]
            for c in both
        }

    t, o = likelihood(toxic), likelihood(ordinary)
    return {c: (both[c], math.log(t[c] / o[c])) for c in both}


def sample(n, seed=1):
    rng = random.Random(seed)
    stems = ["vile", "gron"]
    out = []
    for i in range(n):
        words = [rng.choice("ab") + rng.choice(["so", "ta", "ré"]) * rng.randrange(1, 4) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(stems) + rng.choice(["ta", "so", "ré", "a"])
        out.append((i, int(toxic), " ".join(words)))
    return out


def test_ratios_agree_with_the_formulas(spark):
    rows = [(bool(y), t) for _, y, t in sample(60)] + [(True, ""), (False, "É\n\tÉ x")]
    frame = spark.createDataFrame(rows, "label boolean, text string")
    got = {r.code: (r.n, r.ratio) for r in K.ratio_rows(frame).collect()}
    want = brute_ratios(rows)
    assert got.keys() == want.keys()
    for c, (n, ratio) in want.items():
        assert got[c][0] == n and got[c][1] == pytest.approx(ratio, abs=1e-9)


def test_grams_of_several_texts():
    texts = ["", "Ab c", "x\n\ny é"]
    codes, ends, sizes = K.grams(texts)
    split = np.split(codes, np.cumsum(sizes)[:-1])
    for text, own in zip(texts, split, strict=True):
        assert [int(c) for c in own] == [code(g) for g in grams(text)]
    assert len(ends) == sum(len(t.replace("\n", " ").split(" ")) for t in texts)


def tables(spark, rows, clashing=False):
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id long, toxic int")
    return docs(spark, [(i, t) for i, _, t in rows], clashing), labels


def test_unseen_forms_of_toxic_words_are_told_from_clean_texts(spark):
    rows = sample(1200)
    table, labels = tables(spark, rows, clashing=True)
    model = K.train(table, labels, "toxic", F.col("doc_id") < 900)
    got = {r.doc_id: r.score for r in K.score(table, model).collect()}
    assert len(got) == 1200 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.5) == bool(y) for i, y, _ in rows if i >= 900]
    assert sum(held) / len(held) > 0.95
    again = {r.doc_id: r.score for r in K.score(table, K.train(table, labels, "toxic", F.col("doc_id") < 900)).collect()}
    assert again == got


def test_empty_tables_and_odd_rows(spark):
    rows = sample(40)
    table, labels = tables(spark, rows)
    every = F.lit(True)
    odd = docs(spark, [(1, None), (1, ""), (1, "word " * 50_000), (None, "x"), (1, "x"), (1, "x")])
    for known in (labels, labels.limit(0), labels.selectExpr("doc_id", "cast(null as int) as toxic"),
                  labels.selectExpr("cast(null as long) as doc_id", "toxic"),
                  labels.union(labels.selectExpr("doc_id", "1 - toxic"))):
        model = K.train(table, known, "toxic", every)
        scores = [r.score for r in K.score(odd, model).collect()]
        assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)
    assert K.score(odd.limit(0), model).count() == 0
    assert K.train(table.limit(0), labels, "toxic", every).score(np.zeros((1, K.FEATURES))).shape == (1,)


def test_the_table_keeps_the_most_frequent_of_a_slot(spark, monkeypatch):
    rows = [(bool(y), t) for _, y, t in sample(30)]
    frame = spark.createDataFrame(rows, "label boolean, text string")
    ratios = K.ratio_rows(frame)
    table = K.ratio_table(ratios)
    kept = defaultdict(list)
    for r in ratios.collect():
        slot, tag = K.slots_of(np.array([r.code]))
        kept[int(slot[0])].append((r.n, r.code, r.ratio))
    for slot, rows_here in kept.items():
        assert table.ratio[slot] == pytest.approx(max(rows_here)[2], rel=1e-5, abs=1e-6)
    assert (table.of(np.array([123456789], np.uint64)) == 0).all()


def test_ratios_do_not_depend_on_the_number_of_slots(spark):
    rows = sample(300)
    table, labels = tables(spark, rows)
    few, many = (K.train(table, labels, "toxic", F.col("doc_id") < 250, slots=n) for n in (16, K.SLOTS))
    assert few.table.crowded.all()
    got, want = ({r.doc_id: r.score for r in K.score(table, m).collect()} for m in (few, many))
    assert len(got) == 300 and got == pytest.approx(want, abs=1e-9)


def test_tags_tell_all_keys_of_a_slot_apart():
    keys = np.arange(200_000, dtype=np.uint64)
    slot, tag = K.slots_of(keys, 64)
    assert len(set(zip(slot.tolist(), tag.tolist(), strict=True))) == len(keys) and tag.min() > 0


def class_level(rows, order):
    """Counts by class at an order; below the highest, distinct n-grams with the ending."""
    out = []
    for toxic in (True, False):
        counts = Counter(code(g) for label, t in rows for g in grams(t) if label == toxic)
        for k in range(K.ORDER - 1, order - 1, -1):
            counts = Counter(c % 256**k for c in counts)
        out.append(counts)
    return out


def test_unseen_ngrams_take_the_weights_of_their_context(spark):
    rows = [(True, "vile vilest vila"), (False, "good goodly vigo goal"), (True, "grim")]
    frame = spark.createDataFrame(rows, "label boolean, text string")
    table = K.ratio_table(K.all_ratios(frame))

    def weights(context, order):
        logs = []
        for counts in class_level(rows, order):
            own = [n for c, n in counts.items() if c >> 8 == context]
            logs.append(math.log(sum(min(n, K.DISCOUNT) for n in own) / sum(own)) if own else 0.0)
        return logs[0] - logs[1]

    got = table.of(np.array([code(b" vilx"), code(b"qvigx"), code(b"zzzzq")], np.uint64))
    assert got[0] == pytest.approx(weights(code(b" vil"), 5), abs=1e-6) and abs(got[0]) > 0.01
    # Nothing was seen after "qvig" or is "vigx": the context of order 4 decides.
    assert got[1] == pytest.approx(weights(code(b"vig"), 4), abs=1e-6) and abs(got[1]) > 0.01
    assert got[2] == pytest.approx(weights(0, 1), abs=1e-6)


def test_a_toxic_word_counts_from_its_first_occurrence(spark):
    rows = [(True, "vile")] + [(False, "good day")] * 9
    frame = spark.createDataFrame(rows, "label boolean, text string")
    ratios = {r.code: r.ratio for r in K.ratio_rows(frame).collect()}
    assert ratios[code(b" vile")] > 0.05 and ratios[code(b"vile ")] > 0.05


def test_all_rows_that_the_score_does_not_take_are_counted(spark):
    table, labels = tables(spark, sample(200))
    model = K.train(table, labels, "toxic", F.lit(True), sample_rows=10)
    kept = K.labelled_sample(labels, "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, 10)
    left_out = {r.doc_id for r in kept.collect()}
    counts = Counter(code(g) for i, _, t in sample(200) if i not in left_out for g in grams(t))
    got = {r.code: r.n for r in model.ratios.filter(F.col("code") < 1 << 8 * K.ORDER).collect()}
    assert len(left_out) == 10 and got == counts
