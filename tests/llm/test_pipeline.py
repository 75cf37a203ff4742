"""The pipeline against plain Python, stage by stage and as a whole."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import test_line_dedup
import test_line_quality
import test_ngram_join
import test_substring
from decantry.llm.line_quality import Limits
from helpers import corpus, docs
from test_packing import tokens


def rows_of(seed=12):
    extra = [(300 + k, "cut here " + " ".join(f"q{i + k}" for i in range(120)), "b") for k in range(3)]
    return corpus(seed) + extra


def stages_in_python(rows):
    """The rows (doc_id, text, source) after each of the first four stages."""
    out = []
    judged = [(r, test_line_quality.brute([r], Limits(documents=10**9))) for r in rows]
    listed = test_line_quality.boilerplate(rows, Limits())
    assert not listed  # this small table has no line above the limits
    rows = [r for r, found in judged if next(iter(found))[-1]]
    out.append(rows)
    source = {r[0]: r[2] for r in rows}
    rows = [(i, text, source[i]) for i, _, _, text in test_line_dedup.brute(rows)]
    out.append(rows)
    keep = {c for _, c, _ in test_ngram_join.brute(rows)}
    rows = [r for r in rows if r[0] in keep]
    out.append(rows)
    rows = [(i, text, source[i]) for i, _, text in test_substring.brute(rows, 50)]
    out.append(rows)
    return out


def write(spark, rows, path):
    docs(spark, rows, clashing=True).write.parquet(str(path / "documents.parquet"))
    return str(path)


def test_stages_and_the_whole(spark, tmp_path):
    rows = rows_of()
    sf_dir = write(spark, rows, tmp_path)
    want = stages_in_python(rows)
    assert [len(x) for x in want] == sorted((len(x) for x in want), reverse=True)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = table.columns
    for k, ((_, stage), expected) in enumerate(zip(corpus_pipeline.STAGES[:-1], want, strict=True)):
        path = str(tmp_path / f"stage{k}")
        stage(spark, table, sf_dir).write.parquet(path)
        table = spark.read.parquet(path)
        assert table.columns == columns
        got = table.select("doc_id", "text", "source", "n_chars").collect()
        assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(expected)
        assert all(r.n_chars == len(r.text) for r in got)
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    whole = {}
    for row in packed.sort_values(["doc_id", "start"]).itertuples():
        whole.setdefault(row.doc_id, []).extend(np.frombuffer(row.ids, "<u4").tolist())
    assert sorted(whole.items()) == tokens(want[-1])
    assert len(want[-1]) < len(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "too short"), (2, "")]])
def test_nothing_left(spark, rows):
    table = docs(spark, rows)
    assert corpus_pipeline.STAGES[0][1](spark, table, "").count() == 0
    for _, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, table, "").count()


def test_five_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "substring dedup", "packing",
    ]


def test_lines_above_the_limits_go_from_kept_documents(spark):
    own = lambda i: " ".join(f"x{chr(97 + i % 26)}{chr(97 + i // 26)}y{k}" for k in range(60))
    rows = [(i, f"{own(i)}\nPage {i % 10}\nend {own(i + 500)}", "a") for i in range(25)]
    # Rejected ones count for the limits: "short" is in 15 kept and 10 rejected documents.
    rows = [(i, text + ("\nshort" if i < 15 else ""), host) for i, text, host in rows]
    rows += [(100 + i, f"r{i}\nshort", "a") for i in range(10)]
    rows += [(200, f"{own(200)}\nPage 3", "b")]
    table = docs(spark, rows, clashing=True)
    limits = Limits()
    listed = test_line_quality.boilerplate(rows, limits)
    assert {line for _, line in listed} == {"page 0", "short"}
    want = {
        i: "\n".join(
            x for x in text.split("\n") if (host, test_line_quality.normal(x)) not in listed
        )
        for i, text, host in rows
        if not 100 <= i < 200
    }
    kept = corpus_pipeline.STAGES[0][1](spark, table, "")
    assert kept.columns == table.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert got == {i: (text, len(text)) for i, text in want.items()}
