from collections import Counter, defaultdict

import pytest
from decantry.llm.line_quality import Limits, boilerplate as listed_lines
from decantry.llm.line_quality import cleaned, judge, without_boilerplate
from helpers import corpus, docs, words
from pyspark.sql import functions as F

SYMBOLS = set("#*$%&|<>")


def stripped(line):
    return line.strip(" \t\n\x0b\x0c\r")


def normal(line):
    return "".join("0" if c in "123456789" else c.lower() if c.isascii() else c for c in stripped(line))


def boilerplate(rows, limits):
    seen, of = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        of[host or ""].add(text or "")
        for line in (text or "").split("\n"):
            if stripped(line):
                seen[host or "", normal(line)].add(text or "")
    return {
        k for k, v in seen.items()
        if len(v) > limits.documents and len(v) > limits.share * len(of[k[0]])
    }


def brute(rows, limits):
    listed = boilerplate(rows, limits)
    out = []
    for key, text, host in rows:
        ws = words(text)
        triples = Counter(zip(ws, ws[1:], ws[2:]))
        covered = {
            j for i in range(len(ws) - 2) if triples[tuple(ws[i : i + 3])] > 1 for j in range(i, i + 3)
        }
        lines = [x for x in (text or "").split("\n") if stripped(x)]
        gone = sum(len(words(x)) for x in lines if (host or "", normal(x)) in listed)
        failed = len(ws) < limits.min_words or 100 * len(covered) > 50 * len(ws)
        left = len(ws) - gone
        kept = not failed and left >= limits.min_words and left >= limits.min_left * len(ws)
        out.append(
            (key, len(ws), sum(map(len, ws)), sum(c in SYMBOLS for c in text or ""),
             len(lines) - len(set(lines)), len(covered), gone, failed, kept)
        )
    return Counter(out)


COLUMNS = [
    "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_boilerplate_words", "base_failed", "kept",
]


@pytest.mark.parametrize("limits", [Limits(), Limits(documents=2, share=0.0, min_words=5, min_left=0.8)])
def test_counts_and_verdicts(spark, limits):
    rows = corpus(3) + [(90, "a b c a b c a b c é#*", "a"), (None, "no id\n5 x\n7 x", "a")]
    rows += [rows[5], rows[5]]
    got = judge(docs(spark, rows, clashing=True), limits=limits).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, limits)
    assert any(r.kept for r in got) and not all(r.kept for r in got)


def test_copies_of_a_text_are_no_boilerplate(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text, "a") for i in range(30)]
    assert judge(docs(spark, rows)).filter("kept").count() == 30


def test_digits_and_case_do_not_tell_lines_apart_but_hosts_do(spark):
    body = lambda i: "\n".join(["Page %d OF 9" % i if i % 2 else "page %d of 9" % i, f"own{chr(97 + i)} " * 3])
    rows = [(i, body(i), "a") for i in range(1, 9)] + [(20, body(1), "b")]
    got = judge(docs(spark, rows), limits=Limits(documents=3, share=0, min_words=1, min_left=0))
    gone = {r.doc_id: r.n_boilerplate_words for r in got.select("row.doc_id", "n_boilerplate_words").collect()}
    assert gone == {**{i: 4 for i in range(1, 9)}, 20: 0}
    left = without_boilerplate(docs(spark, rows), limits=Limits(documents=3, share=0))
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[1] == "ownb ownb ownb " and texts[20] == body(1)


def test_columns_stay_and_empty_tables_pass(spark):
    table = docs(spark, corpus(1), clashing=True)
    kept = judge(table).filter("kept").select("row.*")
    assert kept.columns == table.columns
    assert judge(table.limit(0)).count() == 0


def test_no_python_runs(spark):
    plan = judge(docs(spark, corpus(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Eval" not in plan and "InArrow" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("limits", [Limits(), Limits(documents=2, share=0.0, min_words=5, min_left=0.3)])
def test_cleaned_is_what_is_kept_without_its_lines(spark, limits):
    rows = corpus(3) + [(91, "Some words\n" * 3 + "this line stands in many documents, number 1", None)]
    rows += [rows[5], rows[5], (None, rows[6][1], "a")]
    table = docs(spark, rows, clashing=True).withColumn("of", F.lit("x"))
    got = cleaned(table, limits=limits)
    kept = judge(table, limits=limits).filter("kept").select("row.*", "n_boilerplate_words")
    want = without_boilerplate(kept, limits=limits, listed=listed_lines(table, limits=limits))
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert limits == Limits() or got.filter("n_boilerplate_words > 0").count() > 3
    assert cleaned(table.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Eval" not in plan and "InArrow" not in plan and "InPandas" not in plan
