"""Spelling variants against a brute-force version over all pairs of words."""

import random
import zlib
from collections import Counter

from decantry.llm import spelling
from helpers import docs


def counted(rows, every=None, least=7):
    import re

    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if every and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    form, out = {}, set()
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def check(spark, rows, every=None, **options):
    words = spelling.count_words(docs(spark, rows, **options), lose_every=every)
    got = [tuple(r) for r in spelling.variants(words).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(counted(rows, every))
    return got


def test_against_brute_force(spark):
    rng = random.Random(11)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 11))) for _ in range(60)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(60):
            word = stems[int(len(stems) * rng.random() ** 3)]
            if rng.random() < 0.3:
                k = rng.randrange(len(word) + 1)
                word = rng.choice([word[:k] + "b" + word[k:], word[:k] + "c" + word[k + 1 :], word[:k] + word[k + 1 :]])
            text.append(rng.choice([word, word.upper(), word]))
        rows.append((i, rng.choice([" ", ", ", "-", "7"]).join(text)))
    found = check(spark, rows)
    assert sum(r[4] > 0 for r in found) > 100
    check(spark, rows, every=5)


def test_chains_repeats_and_ends(spark):
    chain = ["abcdefg"] * 2000 + ["abcdefgh"] * 200 + ["xabcdefgh"] * 20 + ["xabcdefghy"] * 2
    runs = ["a" * k for k in range(7, 30) for _ in range(2)]
    rows = [(1, " ".join(chain)), (2, " ".join(runs)), (2, " ".join(runs)), (None, "abcdefg abcdefg")]
    got = {r[0]: r for r in check(spark, rows)}
    assert got["xabcdefghy"][2] == "abcdefg" and got["aaaaaaaaaa"][4] == 2
    check(spark, rows, every=2)


def test_very_long_words(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcd") for _ in range(200_000))
    other = long[:150_000] + "z" + long[150_001:]
    third = long[:9] + long[10:]
    text = f"{long} {other} {third} {long} {other} {third}"
    got = {len(r[0]): r for r in check_long(spark, [(1, text)])}
    assert got[199_999][4] == 1 and sum(r[4] for r in got.values()) >= 1


def check_long(spark, rows):
    words = spelling.count_words(docs(spark, rows))
    got = [tuple(r) for r in spelling.variants(words).collect()]
    assert sorted(r[4] for r in got) == [1, 1, 2]
    return got


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "short words only"), (4, "seventy seventy"), (4, "seventy seventy")]
    assert check(spark, rows, clashing=True) == [("seventy", None, "seventy", 4, 0, None)]
    assert check(spark, []) == []
