from collections import Counter
from itertools import combinations

import pytest
from decantry.llm.components import components
from decantry.llm.ngram_join import choose_bands, near_duplicates, one_of_each
from helpers import corpus, docs, words


def grams(text):
    ws = words(text)
    n = min(5, len(ws))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else set()


def brute(rows):
    """Per row its class id and links; ``rows`` are (doc_id, text, ...)."""
    sets = [grams(r[1]) for r in rows]
    near = [set() for _ in rows]
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            near[i].add(j)
            near[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        named = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], min(named, default=None), len(near[i])))
    return Counter(out)


@pytest.mark.parametrize("block_grams", [100_000, 150])
def test_classes_and_links(spark, block_grams):
    rows = corpus(5) + [(None, corpus(5)[44][1], "a"), (None, "two words", None), (99, "ONE", "a")]
    rows += [rows[44], (44, "another text of an id that is there before", "a")]
    found = near_duplicates(docs(spark, rows, clashing=True), block_grams=block_grams)
    got = found.select("doc_id", "class_id", "n_links").collect()
    assert Counter(tuple(r) for r in got) == brute(rows)
    assert max(r.n_links for r in got) > 4


def test_one_row_of_each_class_stays(spark):
    rows = corpus(6)
    rows += [rows[45], rows[45]]
    table = docs(spark, rows, clashing=True)
    kept = one_of_each(table)
    assert kept.columns == table.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == Counter({c for _, c, _ in brute(rows)})
    assert one_of_each(table.limit(0)).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = choose_bands(threshold, 0.999)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999
        assert bands * rows <= 128
    assert choose_bands(0.8, 0.9999) == (25, 5)


def test_components_of_a_path_a_star_and_a_loop(spark):
    path = [(i, i + 1) for i in range(100, 130)]
    star = [(1, i) for i in range(2, 40)]
    edges = spark.createDataFrame(path[::-1] + star + [(7, 7), (500, 499), (499, 500)], "x long, y long")
    got = {r.node: r.root for r in components(edges).collect()}
    want = {i: 100 for i in range(101, 131)} | {i: 1 for i in range(2, 40)} | {500: 499}
    assert got == want
    assert components(edges.limit(0)).count() == 0
