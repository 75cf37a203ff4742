import random

import pytest
from decantry.llm import prefix_hash as H
from helpers import corpus, docs, sha


def test_spans_and_common_extensions():
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice("ab\x00é😀") for _ in range(rng.randrange(60)))
        u = t[rng.randrange(5) :] + "x"
        a, b = H.PrefixHashes(t), H.PrefixHashes(u)
        i, j = rng.randint(0, len(t)), rng.randint(0, len(u))
        n = 0
        while i + n < len(t) and j + n < len(u) and t[i + n] == u[j + n]:
            n += 1
        assert H.common_extension(a, i, b, j) == n
        for size in range(min(len(t) - i, len(u) - j) + 1):
            assert (a.span(i, size) == b.span(j, size)) == (t[i : i + size] == u[j : j + size])


def test_all_spans_at_once():
    h = H.PrefixHashes("abcabcabd")
    assert h.spans(3).tolist() == [h.span(i, 3)[0] for i in range(7)]
    assert len(H.PrefixHashes("ab").spans(12)) == 1


def test_fingerprints_read_back_and_tell_texts_apart():
    rng = random.Random(5)
    seen = {}
    for n in [0, 1, 2, 31, 32, 33, 64, 1000, 70_000]:
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        made = H.Fingerprint.of(text)
        assert H.Fingerprint.read(str(made)) == made == H.Fingerprint.of(text)
        assert seen.setdefault(str(made), text) == text
        if n:
            changed = text[: n // 2] + "z" + text[n // 2 + 1 :]
            assert str(H.Fingerprint.of(changed)) != str(made)
            assert H.likeness(made, H.Fingerprint.of(changed)) < 1
        assert H.likeness(made, made) == 1
    long, short = H.Fingerprint.of("ab" * 5000), H.Fingerprint.of("ab" * 3000)
    assert 0.55 < H.likeness(long, short) <= 1 and H.likeness(long, short) == H.likeness(short, long)


def brute(rows):
    order = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], r[1] or ""))
    out = []
    for k, row in enumerate(order):
        text, follow = row[1] or "", order[(k + 1) % len(order)][1] or ""
        changed = H.edited(text, follow)
        a, b, c = (H.Fingerprint.of(x) for x in (text, changed, follow))
        out.append((row[0], len(text), sha(changed), str(a), str(b), H.likeness(a, b), H.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", ["1", "7", "60"])
def test_every_row_meets_its_follower(spark, ranges):
    rows = corpus(4) + [(None, "no id", "a"), (3, "again", "a"), (3, "again", "a"), (-5, None, "b")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = H.edited_fingerprints(docs(spark, rows, clashing=True)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_few_rows_and_the_simple_operator(spark):
    for rows in ([(5, "alone by itself")], [(5, "x" * 9), (5, "y" * 9)], [(1, None)]):
        got = H.edited_fingerprints(docs(spark, rows)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert H.edited_fingerprints(docs(spark, [])).count() == 0
    rows = corpus(4)
    got = {(r.doc_id, r.fingerprint) for r in H.fingerprints(docs(spark, rows)).collect()}
    assert got == {(r[0], str(H.Fingerprint.of(r[1] or ""))) for r in rows}


def test_an_edited_text_is_nearer_than_another():
    rng = random.Random(8)
    for n in (40, 400, 4000):
        a, b = ("".join(rng.choice("abcdefghij ") for _ in range(n)) for _ in range(2))
        own, changed, other = (H.Fingerprint.of(x) for x in (a, H.edited(a, b), b))
        assert H.likeness(own, changed) > 0.6 and H.likeness(own, other) < 0.2
