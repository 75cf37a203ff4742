"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from decantry.workload import QUERIES, SQL

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= queries().keys() and SQL.keys() <= oracle_sql().keys()


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    mine = QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(mine.columns) == sorted(columns)
    rows = result.fetchall()
    assert rows
    assert table_of(mine.columns, mine.collect()) == table_of(columns, rows)
