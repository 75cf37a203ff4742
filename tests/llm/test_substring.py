import random
from collections import Counter

import numpy as np
import pytest
from decantry.llm import substring as S
from helpers import corpus, docs, words


def brute(rows, window):
    first = {}
    for i, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        ws = words(text)
        for k in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[k : k + window]), i)
    out = Counter()
    for i, text, *_ in rows:
        ws = words(text)
        gone = set()
        for k in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i, len(gone), " ".join(w for j, w in enumerate(ws) if j not in gone) if gone else text] += 1
    return out


def result(spark, rows, window, clashing=False, **options):
    table = docs(spark, rows, clashing)
    found = S.repeated_windows(table, window=window, **options)
    left = S.drop_windows(table, found, window=window, n_removed="count_gone")
    assert left.columns == [*table.columns, "count_gone"]
    return Counter(tuple(r) for r in left.select("doc_id", "count_gone", "text").collect())


@pytest.mark.parametrize("hot", [10_000, 2])
def test_words_go_as_said(spark, hot):
    rows = corpus(7) + [(None, corpus(7)[40][1], "a"), corpus(7)[60], corpus(7)[60]]
    rows += [(60, "another text of that id " + " ".join(f"p{k}" for k in range(70)), "a")]
    got = result(spark, rows, 50, clashing=True, hot=hot)
    assert got == brute(rows, 50)
    assert sum(n for (_, gone, _), n in got.items() if gone) > 10


@pytest.mark.parametrize("hot", [10_000, 1])
def test_small_windows_with_many_ties(spark, hot):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(30))), "a") for i in range(40)]
    assert result(spark, rows, 6, run=2, hot=hot) == brute(rows, 6)


def test_empty_tables(spark):
    assert result(spark, [], 50) == Counter()
    rows = [(1, None), (2, ""), (None, "x " * 80)]
    assert result(spark, rows, 50) == brute(rows, 50)


def test_a_long_text_that_repeats_itself_keeps_its_words(spark):
    rows = [(1, "x y z " * 20_000), (2, "x y z " * 40)]
    got = result(spark, rows, 50)
    assert got[1, 0, rows[0][1]] == 1 and got[2, 120, ""] == 1


def test_super_kmers_cover_each_window_once():
    rng = random.Random(1)
    for _ in range(50):
        ws = [rng.choice("abcdef").encode() for _ in range(rng.randrange(10, 80))]
        hashes = S.hash_words(ws)
        minimiser, starts, counts = S.super_kmers(hashes, 10, 3)
        assert np.concatenate([np.arange(s, s + n) for s, n in zip(starts, counts, strict=True)]).tolist() == list(range(len(ws) - 9))
        values = S.rolling(hashes[:1], 3)[0].astype(np.uint64)
        for m, s, n in zip(minimiser, starts, counts, strict=True):
            for k in range(s, s + n):
                assert values[k : k + 8].min() == np.uint64(np.int64(m).view(np.uint64))


def test_equal_words_have_equal_hashes_after_forgetting():
    known = S.WordHashes(most=5)
    a = known([b"x", b"y"])
    known([str(i).encode() for i in range(50)])
    assert (known([b"x", b"y"]) == a).all() and (a == S.hash_words([b"x", b"y"])).all()
