"""The registered queries on the smallest tables: against SQL, or against brute force."""

import os
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import test_pii
import test_prefix_hash
import test_substring
import tiktoken
from decantry.llm.queries import BPE_RANKS, LLM_QUERIES, LLM_SQL, vocabulary
from helpers import sha, words
from test_packing import tokens

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
LARGE = Path("/root/testdata/sf0.1")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("select doc_id, text from documents").fetchall()


def run(spark, name):
    return LLM_QUERIES[name](spark, str(SF_DIR))


def test_one_query_for_each_number():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
    assert LLM_SQL.keys() <= LLM_QUERIES.keys()


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_agrees_with_sql(spark, duck, name):
    mine = run(spark, name)
    result = duck.execute(LLM_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(mine.columns) == sorted(columns)
    assert Counter(tuple(r) for r in mine.select(*columns).collect()) == Counter(result.fetchall())


def test_packing(spark, documents):
    got = run(spark, "op6_packing").toPandas()
    want = dict(tokens(documents))
    for row in got.itertuples():
        part = want[row.doc_id][row.start : row.start + row.length]
        raw = b"".join(i.to_bytes(4, "little") for i in part)
        assert row.ids_crc32 == zlib.crc32(raw) and row.doc_tokens == len(want[row.doc_id])
    assert got["length"].sum() == sum(map(len, want.values()))
    fill = got.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 1024 and (1024 - fill).sum() < 0.05 * fill.sum()


def test_byte_bpe(spark, documents):
    import public_tokenizers
    from decantry.llm.byte_bpe import read_ranks

    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(vocabulary(BPE_RANKS)),
        special_tokens={},
    )
    want = set()
    for doc_id, text in documents:
        ids = encoding.encode_ordinary(text or "")
        want.add((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert {tuple(r) for r in run(spark, "op7_byte_bpe").collect()} == want


def test_prefix_hashes(spark, documents):
    got = run(spark, "op8_prefix_hashes").collect()
    assert sorted((tuple(r) for r in got), key=repr) == test_prefix_hash.brute(documents)
    assert sum(r.near_edited > 0.6 for r in got) > 0.99 * len(got)


def test_super_kmers(spark, documents):
    got = {tuple(r) for r in run(spark, "op10_super_kmers").collect()}
    whole = dict(documents)
    want = {
        (i, len(words(whole[i])), gone, sha(" ".join(words(text))))
        for i, gone, text in test_substring.brute(documents, 50)
    }
    assert got == want


def test_pii_base(spark, documents):
    got = run(spark, "op12_pii").collect()
    assert len(got) == len(documents)
    whole = dict(documents)
    for row in got:
        base = [f"{k}:{s}:{e}" for k, s, e in test_pii.brute(whole[row.doc_id])]
        for kind in test_pii.PLAIN:
            assert row[f"n_{kind}"] == sum(b.startswith(kind) for b in base)
        assert row.base_sha256 == sha(",".join(base))
        assert set(base) <= set(row.spans.split(","))


@pytest.mark.parametrize(
    "name, label, modulus, remainder, cut, least",
    [
        ("op4_kneser_ney", "toxic", 5, 0, 0.5, (0.95, 0.6)),
        ("op9_quality_trees", "quality", 4, 2, 0.7, (0.95, 0.95)),
    ],
)
def test_classifiers(spark, duck, documents, name, label, modulus, remainder, cut, least):
    rows = run(spark, name).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    # The smallest tables hold out a handful of the rarer label.
    large = LARGE if LARGE.exists() else SF_DIR
    known = dict(duckdb.sql(f"select doc_id, {label} from '{large}/labels.parquet'").fetchall())
    held = [r for r in LLM_QUERIES[name](spark, str(large)).filter("held_out").collect() if r.doc_id in known]
    for value in (0, 1):  # a constant finds none of one of them
        own = [r.predicted == value for r in held if known[r.doc_id] == value]
        assert sum(own) >= least[value] * len(own)
