import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from decantry import labels as L
from decantry.operators import copies
from decantry.plans import Lakehouse, Refinement
from decantry.plans.runs import ingest_rows
from decantry.session import Scratch
from decantry.sources import Table

SCHEMA = f"{L.ROW_DIGEST} string, name string"


def hexed(i):
    return f"{i:064x}"


# Digests, and what only looks like one: of upper case, of odd length, raw text, nothing.
DIGESTS = [*map(hexed, range(40)), "AB" * 32, "ab" * 32, "abc", "0abc", "ABC", "", "text", "é" * 32, None]


def rows_of(spark, seed):
    rng = random.Random(seed)
    rows = [(d, f"{d}") for d in DIGESTS for _ in range(rng.randrange(4))]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("limit", [0, 64 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_copies_beyond_the_stored_ones_stay_at_any_size(spark, monkeypatch, limit, seed):
    monkeypatch.setattr(copies, "BROADCAST_BYTES", limit)
    (new, rows), (old, stored) = rows_of(spark, seed), rows_of(spark, seed + 10)
    with Scratch(spark) as scratch:
        got = Counter(map(tuple, copies.beyond(scratch, rows, len(new), stored).collect()))
    want = Counter(new) - Counter(old)
    want[(None, "None")] = Counter(new)[(None, "None")]  # rows without a digest match nothing
    assert got == +want


def test_many_digests_are_shuffled_once_and_as_bytes(spark, monkeypatch):
    monkeypatch.setattr(copies, "BROADCAST_BYTES", 0)
    plans = []
    keep = Scratch.keep

    def watched(self, df, *conditions):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, *conditions)

    monkeypatch.setattr(Scratch, "keep", watched)
    digests = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias(L.ROW_DIGEST))
    with Scratch(spark) as scratch:
        assert copies.beyond(scratch, digests, 5000, digests.limit(10)).count() == 4990
    exchanges = [x for x in plans[0].splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "unhex" in plans[0], plans[0]
    assert "Join" not in plans[0]


def contracts(spark, n=20_000):
    return spark.range(n).select("id", F.lit(1.0).alias("price"), F.lit(dt.date(2020, 1, 1)).alias("day"))


def test_a_first_delivery_is_written_once(spark, tmp_path, monkeypatch):
    rows = contracts(spark, 10)
    lake = Lakehouse(str(tmp_path / "lake"), contract=rows.schema)
    job = Refinement(lake, as_of=dt.date(2021, 1, 1), once=True)
    kept = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, *c: kept.append(1) or keep(self, df, *c))
    assert ingest_rows(spark, job, rows, "first", write="a") == 10
    assert not kept
    assert ingest_rows(spark, job, rows, "first", write="a") == 10  # takes its own place
    assert ingest_rows(spark, job, rows, "again") == 0
    assert lake.bronze.read(spark).count() == 10


def stored_bytes(folder):
    files = [pq.ParquetFile(p).metadata for p in Path(folder).rglob("*.parquet")]
    columns = [f.row_group(g).column(c) for f in files for g in range(f.num_row_groups) for c in range(f.num_columns)]
    return sum(c.total_compressed_size for c in columns if c.path_in_schema == L.ROW_DIGEST)


def test_a_stored_digest_takes_little_more_than_its_32_bytes(spark, tmp_path):
    n = 20_000
    rows = spark.range(0, n, 1, 1).select(
        F.sha2(F.col("id").cast("string"), 256).alias(L.ROW_DIGEST), (F.col("id") % 2 == 0).alias("even")
    )
    for name, write in (
        ("append", lambda t: t.append(rows)),
        ("overwrite", lambda t: t.overwrite(rows)),
        ("split", lambda t: t.split(rows, F.col("even"), [L.ROW_DIGEST])),
    ):
        write(Table(str(tmp_path / name)))
        assert 32 * n <= stored_bytes(tmp_path / name) < 42 * n
    with Scratch(spark) as scratch:
        scratch.keep(rows)
        assert stored_bytes(scratch.folders[0].removeprefix("file:")) < 42 * n
