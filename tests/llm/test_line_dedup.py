from collections import Counter, defaultdict

import numpy as np
import pytest
from decantry.llm.line_dedup import Stream, compress, drop_lines, keep_flags, line_keeps
from helpers import corpus, docs


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_chars=20, min_documents=3):
    holders = defaultdict(set)
    for i, text, *_ in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(i)
    latest = {k: max(v) for k, v in holders.items() if len(v) >= min_documents}
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or latest.get(key(x), i) == i]
        gone = len(lines) - len(kept)
        out[i, len(lines), gone, "\n".join(kept) if gone else text] += 1
    return out


def result(spark, rows, clashing=False, **options):
    table = docs(spark, rows, clashing)
    keeps = line_keeps(table, **options)
    left = drop_lines(table, keeps, n_lines="count_all", n_dropped="count_gone")
    assert left.columns == [*table.columns, "count_all", "count_gone"]
    return Counter(tuple(r) for r in left.select("doc_id", "count_all", "count_gone", "text").collect())


ROWS = corpus(8) + [
    (200, "Äpfel und Birnen und Zwetschgen", "a"),
    (201, "äpfel und Birnen und Zwetschgen", "a"),
    (202, "Äpfel und Birnen und Zwetschgen \nx", "b"),
    (203, "Äpfel UND birnen und Zwetschgen\nÄpfel und Birnen und Zwetschgen", "b"),
    (None, "this line stands in many documents, number 1", "a"),
]


def test_lines_go_as_said(spark):
    rows = ROWS + [ROWS[7], ROWS[7], (ROWS[7][0], "this line stands in many documents, number 2")]
    assert result(spark, rows, clashing=True) == brute(rows)
    assert result(spark, rows, min_chars=1, min_documents=2) == brute(rows, 1, 2)


def test_a_hot_line_over_several_ranges(spark):
    line = "one line that every document has, word for word"
    rows = [(i, f"{line}\nown line of document number {i}\n{line}", "a") for i in range(400)]
    rows += [(i, f"a second line, of two documents only\n{line}", "a") for i in (500, 501)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert result(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_tables(spark):
    assert result(spark, []) == Counter()
    assert result(spark, [(1, None), (2, ""), (None, None)]) == brute([(1, None), (2, ""), (None, None)])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_batches_may_end_anywhere(size):
    rng = np.random.default_rng(3)
    rows = sorted(
        {(int(h), int(h) % 2, -int(d), int(p)) for h, d, p in rng.integers(0, [6, 5, 4], (60, 3))}
    )
    table = np.array([(h1, h2, -d, p) for h1, h2, d, p in rows])
    stream = Stream(3, {})
    got = set()
    for start in range(0, len(table), size):
        part = table[start : start + size]
        got |= {tuple(x) for x in stream(part[:, 0], part[:, 1], part[:, 2], part).tolist()}
    want = set()
    for h in {(r[0], r[1]) for r in table.tolist()}:
        own = [r for r in table.tolist() if (r[0], r[1]) == h]
        holders = {r[2] for r in own}
        want |= {tuple(r) for r in own if len(holders) >= 3 and r[2] != max(holders)}
    assert got == want


def test_bitmaps_are_small_and_exact():
    dropped = [3, 4, 99_999]
    bitmap = compress(dropped)
    assert len(bitmap) < 200
    flags = keep_flags(bitmap)
    assert len(flags) == 100_000 and np.flatnonzero(~flags).tolist() == dropped
