import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from decantry import files
from decantry.sources import CommitLog, SchemaConflict, Table, align_to, commit_metrics


def ddl(text):
    return T.StructType.fromDDL(text)


def test_append_adds_new_columns_as_null(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    assert table.append(spark.sql("select 1 as a, 'x' as b")) == 1
    assert table.append(spark.sql("select 'y' as b, cast(2 as int) as a, date'2024-01-01' as c")) == 1
    out = table.read(spark)
    assert out.columns == ["a", "b", "c"]
    assert {tuple(r) for r in out.collect()} == {
        (1, "x", None),
        (2, "y", dt.date(2024, 1, 1)),
    }


def test_append_fills_columns_the_rows_lack(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table.append(spark.sql("select 1L as a, 'x' as b"))
    table.append(spark.sql("select cast(2 as int) as A"))
    assert {tuple(r) for r in table.read(spark).collect()} == {(1, "x"), (2, None)}
    assert table.read(spark).schema["a"].dataType == T.LongType()


@pytest.mark.parametrize(
    ("stored", "incoming"),
    [("int", "bigint"), ("int", "string"), ("date", "string"), ("double", "bigint"),
     ("decimal(5,2)", "decimal(8,2)"), ("decimal(8,1)", "decimal(8,2)")],
)
def test_lossy_change_raises(spark, stored, incoming):
    df = spark.sql(f"select cast(null as {incoming}) as a")
    with pytest.raises(SchemaConflict, match="a:"):
        align_to(df, ddl(f"a {stored}"))


@pytest.mark.parametrize(
    ("stored", "incoming"),
    [("bigint", "int"), ("string", "date"), ("string", "bigint"), ("double", "int"),
     ("decimal(10,3)", "decimal(8,2)"), ("timestamp", "date"), ("string", "void")],
)
def test_widening_is_allowed(spark, stored, incoming):
    df = spark.sql(f"select cast(null as {incoming}) as a")
    assert align_to(df, ddl(f"a {stored}")).schema == ddl(f"a {stored}")


def test_a_declared_schema_grows_and_keeps_its_types(spark, tmp_path):
    table = Table(str(tmp_path / "t"), schema=ddl("a int"))
    table.append(spark.sql("select 1 as a"))
    table.append(spark.sql("select 2 as a, 'x' as surplus"))
    table.append(spark.sql("select 3 as a"))
    assert {tuple(r) for r in table.read(spark).collect()} == {(1, None), (2, "x"), (3, None)}
    assert Table(table.path).read(spark).columns == ["a", "surplus"]
    with pytest.raises(SchemaConflict, match="a:"):
        table.append(spark.sql("select 1L as a"))
    with pytest.raises(SchemaConflict, match="surplus:"):
        table.append(spark.sql("select 1 as a, array(1) as surplus"))


def test_reads_use_the_stored_schema(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table.append(spark.sql("select 1 as a"))
    table.append(spark.sql("select 1 as a, 2 as b"))
    assert table.layout(spark).names == ["a", "b"]
    # A table that something else has written has none, and is merged.
    other = Table(str(tmp_path / "other"))
    spark.sql("select 1 as a").write.parquet(other.path)
    spark.sql("select 1 as a, 2 as b").write.mode("append").parquet(other.path)
    assert other.layout(spark) is None and sorted(other.read(spark).columns) == ["a", "b"]
    other.overwrite(spark.sql("select 5L as c"))
    assert other.read(spark).columns == ["c"]


def test_declared_schema_reads_older_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select 1 as a").write.parquet(path)
    assert Table(path, schema=ddl("a int, b string")).read(spark).first().asDict() == {
        "a": 1,
        "b": None,
    }


@pytest.mark.parametrize("schema", [None, "a int"])
def test_missing_table(spark, tmp_path, schema):
    table = Table(str(tmp_path / "nowhere"), schema=schema and ddl(schema))
    assert table.read_or_none(spark) is None
    with pytest.raises(AnalysisException):
        table.read(spark)


def test_other_read_errors_surface(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"these are not columns")
    with pytest.raises(Exception, match="FAILED_READ_FILE|footer|Parquet"):
        Table(str(tmp_path / "t")).read_or_none(spark)


def test_overwrite_replaces_and_empty_write_is_counted(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    assert table.overwrite(spark.range(5).toDF("a")) == 5
    assert table.overwrite(spark.range(7).toDF("b").filter("b > 4")) == 2
    assert table.read(spark).columns == ["b"]
    assert table.append(spark.range(3).toDF("b").filter("b > 4"), compact=True) == 0
    assert table.read(spark).count() == 2


def test_compacting_writes_few_files(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    rows = spark.range(0, 1000, 1, 40).toDF("a").filter("a % 10 = 0")
    assert table.append(rows, compact=True) == 100
    assert len(list((tmp_path / "t").rglob("*.parquet"))) < 8
    assert table.read(spark).count() == 100


def commit_line(rows, size, mode="Overwrite", at=1):
    return (
        f'{{"commitInfo":{{"timestamp":{at},"operation":"WRITE","operationParameters":'
        f'{{"mode":"{mode}"}},"operationMetrics":{{"numFiles":"1","numOutputRows":"{rows}",'
        f'"numOutputBytes":"{size}"}}}}}}\n{{"protocol":{{"minReaderVersion":1}}}}\n'
    )


def test_last_commit_of_a_delta_log(spark, tmp_path):
    silver = tmp_path / "silver"
    silver.mkdir()
    # The later version has the earlier clock: versions decide.
    (silver / "00000000000000000000.json").write_text(commit_line(1000, 16921, at=9))
    (silver / "00000000000000000001.json").write_text(commit_line(2000, 36246, at=8))
    (silver / "00000000000000000001.checkpoint.parquet").write_bytes(b"not json")
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "00000000000000000000.json").write_text(commit_line(5, 6))
    (plain / "00000000000000000001.json").write_text('{"add":{"path":"x"}}\n')
    logs = [
        CommitLog("real", "silver", str(silver)),
        CommitLog("real", "quarantine", str(plain)),
        CommitLog("real", "bronze", str(tmp_path / "missing")),
    ]
    got = {r["layer"]: (r["rows"], r["bytes"]) for r in commit_metrics(spark, logs).collect()}
    assert got == {"silver": (2000, 36246), "quarantine": (0, None), "bronze": (0, None)}


def test_recorded_commits(spark, tmp_path):
    log = CommitLog("t", "silver", str(tmp_path / "commits"))
    for n in (3, 4):
        at = dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)
        log.record(spark, "append", rows=n, size=10 * n, at=at)
    assert commit_metrics(spark, [log]).first().asDict() == {
        "table_set": "t",
        "layer": "silver",
        "rows": 4,
        "bytes": 40,
        "judged": 4,
    }
    log.record(spark, "append", rows=1, size=None, judged=9)
    last = commit_metrics(spark, [log]).first()
    assert (last["rows"], last["bytes"], last["judged"]) == (1, None, 9)


def test_bytes_are_those_of_a_write(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    for name in ("a", "b"):
        table.append(spark.range(10).toDF("x"), write=name)
    for name in ("a", "b"):
        size = sum(f.stat().st_size for f in tmp_path.rglob(f"_write={name}/*.parquet"))
        assert files.bytes_below(spark, table.write_folder(spark, name)) == size > 0
    assert files.bytes_below(spark, str(tmp_path / "nowhere")) == 0


def test_struct_members_are_added_at_any_depth(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table.append(spark.sql("select 1 as id, named_struct('a', true, 's', named_struct('x', 1)) as c, array(named_struct('k', 1)) as l"))
    table.append(
        spark.sql(
            "select 2 as id, named_struct('s', named_struct('y', 'n', 'X', 2), 'b', false) as c,"
            " array(named_struct('m', 2.5D, 'k', 3), null) as l"
        )
    )
    table.append(spark.sql("select 3 as id, cast(null as struct<a:boolean>) as c, cast(null as array<struct<k:int>>) as l"))
    out = {r["id"]: r.asDict(recursive=True) for r in table.read(spark).collect()}
    assert out[1]["c"] == {"a": True, "s": {"x": 1, "y": None}, "b": None}
    assert out[2]["c"] == {"a": None, "s": {"x": 2, "y": "n"}, "b": False}
    assert out[1]["l"] == [{"k": 1, "m": None}] and out[2]["l"] == [{"k": 3, "m": 2.5}, None]
    assert out[3]["c"] is None and out[3]["l"] is None
    for lossy in ("named_struct('a', 'text')", "named_struct('s', named_struct('x', 1L))", "true"):
        with pytest.raises(SchemaConflict, match="c"):
            table.append(spark.sql(f"select 4 as id, {lossy} as c"))
    assert table.read(spark).count() == 3


def test_versions_and_writes(spark, tmp_path):
    table = Table(str(tmp_path / "t"), key="k", partition_by=("day",))
    rows = spark.sql("select 1 as k, date'2024-01-01' as day")
    table.append(rows, write="a")
    table.append(rows, write="b")
    table.append(rows.union(rows), write="b")
    assert table.writes(spark) == ["a", "b"] and table.complete(spark)
    assert table.read(spark).count() == 3 and table.read(spark).columns == ["k", "day"]
    late = spark.sql("select 2 as k, cast(null as date) as day, 'b' as _write")
    assert table.replace_writes(late, ["b", "c"]) == 1
    assert sorted(map(tuple, table.read(spark, writes=True).collect()), key=str) == [
        (1, dt.date(2024, 1, 1), "a"), (2, None, "b"),
    ]
    table.append(spark.sql("select cast(null as int) as k, date'2024-01-01' as day"))
    assert not table.complete(spark)
    table.rewrite(spark, table.read(spark, writes=True).fillna({"k": 7}))
    assert table.complete(spark) and table.read(spark).agg({"k": "sum"}).first()[0] == 10
    for _ in range(3):
        table.overwrite(table.read(spark))
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 2
    assert table.append(rows.filter("k > 5")) == 0 and len(table.writes(spark)) == 1


def test_two_runs_do_not_lose_each_others_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    Table(path).append(spark.range(1).toDF("a"))
    one, other = (Table(path, known={}) for _ in range(2))
    assert one.state(spark) == other.state(spark)
    one.overwrite(spark.range(5).toDF("a"))
    for late in (lambda: other.append(spark.range(2).toDF("a")), lambda: other.overwrite(spark.range(2).toDF("a"))):
        with pytest.raises(RuntimeError, match="another run"):
            late()
    assert Table(path).read(spark).count() == 5
    # Appends of two runs are both kept.
    one, other = (Table(path, known={}) for _ in range(2))
    one.append(spark.range(1).toDF("a")), other.append(spark.range(1).toDF("a"))
    assert Table(path).read(spark).count() == 7


def test_a_state_that_was_left_half_written_does_not_count(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    table.append(spark.range(3).toDF("a"))
    state = table.state(spark)
    (tmp_path / "t.state" / f"{state.number + 1:020d}.json").write_text('{"version": "x", "sch')
    assert table.state(spark) == state and table.read(spark).count() == 3
    table.overwrite(spark.range(1).toDF("a"))
    assert table.state(spark).number == state.number + 2 and table.read(spark).count() == 1


def test_files(spark, tmp_path):
    path = str(tmp_path / "x" / "1.json")
    files.claim(spark, path, "{é}")
    with pytest.raises(FileExistsError):
        files.claim(spark, path, "")
    assert files.read_text(spark, path) == "{é}" and files.names(spark, str(tmp_path / "x")) == ["1.json"]
    files.write_new(spark, str(tmp_path / "x" / "2.json"), "b")
    assert files.names(spark, str(tmp_path / "x")) == ["1.json", "2.json"]
    files.delete(spark, path)
    assert not files.exists(spark, path) and files.names(spark, path) == []
