import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from decantry import labels as L
from decantry.operators import layer_balance, layer_comparison, reason_counts, top_reasons
from decantry.plans import (
    Lakehouse,
    Refinement,
    ingest,
    ingest_snapshot,
    refine,
    refine_simple,
    refresh_gold,
    reprocess,
)
from decantry.operators.identity import with_identity
from decantry.operators.copies import beyond
from decantry.plans.runs import Summary, _as_silver, _identified, _settled_ids
from decantry.session import Scratch
from decantry.sources import tables
from decantry.sources import CONTRACT_SCHEMA, Table, commit_metrics, read_contracts

from contract_rows import HEADER, contract_line

DAY1 = dt.date(2024, 6, 1)


@pytest.fixture
def lake(tmp_path):
    return Lakehouse(str(tmp_path / "lake"), contract=CONTRACT_SCHEMA, measure_bytes=True)


@pytest.fixture(params=["declared", "inferred"])
def any_lake(request, tmp_path):
    contract = CONTRACT_SCHEMA if request.param == "declared" else None
    return Lakehouse(str(tmp_path / "lake"), contract=contract, measure_bytes=True)


def job(lake, day=DAY1, **options):
    return Refinement(
        lake, as_of=day, run_ts=dt.datetime.combine(day, dt.time(12)), **options
    )


@pytest.fixture
def mixed_csv(tmp_path):
    """Five rows: sound, dated tomorrow, dated next year, without price, without date."""
    lines = [
        contract_line("sound", "A", "2024-05-01", "10"),
        contract_line("tomorrow", "A", "2024-06-02", "20"),
        contract_line("next year", "B", "2025-06-01", "30"),
        contract_line("no price", "B", "2024-05-01", ""),
        contract_line("no date", "B", "", "50"),
    ]
    path = tmp_path / "mixed.csv"
    path.write_text("\n".join([",".join(HEADER), *lines]) + "\n", encoding="utf-8")
    return str(path)


def entities(df):
    return sorted(r["Entidad"] for r in df.collect())


def test_golden_run(spark, any_lake, contracts_csv):
    lake = any_lake
    out = refine(spark, job(lake, mode="prod"), contracts_csv)
    assert (out.total, out.clean, out.quarantine) == (12, 7, 5)
    assert out.reject_pct == 100.0 * 5 / 12 and out.alert and out.moved is None
    assert out.as_frame(spark).first()["reject_pct"] == 100.0 * 5 / 12

    silver = lake.silver.read(spark)
    extremes = silver.agg(F.min("Precio_Base"), F.max("Precio_Base")).first()
    assert tuple(extremes) == (15, 128000)
    assert L.CODE in silver.columns and silver.filter(F.col(L.CODE).isNotNull()).isEmpty()
    last = [L.REJECT_REASON, L.VALIDATED_AT, L.PIPELINE_VERSION, L.QUARANTINE_ID, L.ATTEMPTS]
    last += [L.DUE_ON, L.VALIDATED_ON]
    if lake.contract is None:
        last = [L.DUE_ON, *(c for c in last if c != L.DUE_ON)]
    held = lake.read_quarantine(spark)
    pairs = sorted((r[L.CODE], r[L.REJECT_REASON]) for r in held.collect())
    assert pairs == [
        ("E001", "Precio Base nulo, Fecha de Firma nula"),
        ("E001", "Precio Base nulo, Fecha de Firma nula"),
        ("E002", "Fecha de Firma futura"),
        ("E003", "Precio Base nulo"),
        ("E004", "Precio Base <= 0"),
    ]
    assert held.columns[15:] == [
        L.INGESTED_AT, L.SOURCE_FILE, L.INGESTED_ON, L.ROW_DIGEST, L.CHECKS, L.IS_VALID, L.REASONS,
        L.CODE, *last, L.REPROCESSED_AT,
    ]

    assert refresh_gold(spark, job(lake)) == 6
    gold = [tuple(r) for r in lake.gold.read(spark).collect()]
    assert gold == [
        ("CENTRO", 128000.0),
        ("SUR", 64000.0),
        ("OESTE", 15765.0),
        ("ESTE", 2200.0),
        ("NORTE", 812.5),
        ("PEÑA", 45.25),
    ]

    metrics = commit_metrics(spark, lake.commit_logs())
    got = {r["layer"]: r for r in metrics.collect()}
    assert {k: v["rows"] for k, v in got.items()} == {"bronze": 12, "silver": 7, "quarantine": 5}
    assert all(r["bytes"] > 0 for r in got.values())
    assert layer_balance(metrics).first().asDict() == {
        "table_set": "contracts",
        "bronze_rows": 12,
        "silver_rows": 7,
        "quarantine_rows": 5,
        "silver_bytes": got["silver"]["bytes"],
        "quarantine_bytes": got["quarantine"]["bytes"],
        "total_rows": 12,
        "valid_pct": 58.3,
        "rejected_pct": 41.7,
    }
    assert tuple(layer_comparison(metrics).first()) == ("contracts", 7, 5)


def test_simple_golden_run(spark, any_lake, contracts_csv):
    lake = any_lake
    assert ingest_snapshot(spark, lake, contracts_csv) == 12
    assert ingest_snapshot(spark, lake, contracts_csv) == 12
    assert refine_simple(spark, lake) == (8, 4)
    assert refine_simple(spark, lake) == (8, 4)
    rows = {r["layer"]: r["rows"] for r in commit_metrics(spark, lake.commit_logs()).collect()}
    assert rows == {"bronze": 12, "silver": 8, "quarantine": 4}
    assert refresh_gold(spark, job(lake)) == 6
    held = replace(lake, snapshot=True).quarantine.read(spark)
    assert held.columns == [*CONTRACT_SCHEMA.names, L.REJECT_REASON]
    assert {tuple(r) for r in reason_counts(held).collect()} == {
        ("Fecha de Firma nula", 2),
        ("Precio Base nulo", 1),
        ("Precio Base <= 0", 1),
    }


@pytest.mark.parametrize(
    ("total", "clean", "limit", "pct", "alert"),
    [
        (100, 95, 5.0, 5.0, False),
        (1000, 949, 5.0, 5.1, True),
        (10, 0, None, 100.0, False),
        (0, 0, 5.0, 0.0, False),
    ],
)
def test_alert_is_for_more_than_the_limit(total, clean, limit, pct, alert):
    out = Summary.of(total, clean, limit)
    assert (out.quarantine, out.reject_pct, out.alert) == (total - clean, pct, alert)


def test_a_run_at_a_given_instant_judges_by_its_day(spark, lake):
    at = dt.datetime(2020, 2, 29, 23)
    clock = Refinement(lake, run_ts=at).clock(spark)
    assert (clock.as_of, clock.run_ts) == (dt.date(2020, 2, 29), at)
    assert Refinement(lake, as_of=DAY1, run_ts=at).clock(spark).as_of == DAY1
    now = Refinement(lake).clock(spark)
    assert now.as_of == spark.sql("select current_date()").first()[0]


def test_missing_bronze(spark, any_lake):
    lake = any_lake
    assert refine(spark, job(lake)) is None
    assert reprocess(spark, job(lake)) == 0


def test_runs_append_without_a_row_key(spark, lake, mixed_csv):
    for n in (1, 2):
        out = refine(spark, job(lake), mixed_csv)
        assert (out.total, out.clean, out.quarantine) == (5 * n, n, 4 * n)
        assert not out.alert
    assert lake.bronze.read(spark).count() == 10
    assert lake.silver.read(spark).count() == 2
    assert lake.quarantine.read(spark).count() == 4 + 8


def test_clean_batch_quarantines_nothing(spark, lake, tmp_path):
    path = tmp_path / "sound.csv"
    path.write_text("\n".join([",".join(HEADER), contract_line("s", "A", "2024-01-01", "1")]))
    out = refine(spark, job(lake, mode="prod"), str(path), reprocess_quarantine=True)
    assert (out.total, out.quarantine, out.reject_pct, out.alert, out.moved) == (1, 0, 0.0, False, 0)


def test_reprocess_moves_rows_once(spark, lake, mixed_csv):
    refine(spark, job(lake), mixed_csv)
    assert reprocess(spark, job(lake)) == 0
    day2 = job(lake, dt.date(2024, 6, 2))
    assert reprocess(spark, day2) == 1
    assert reprocess(spark, day2) == 0
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]
    held = {r["Entidad"]: r for r in lake.read_quarantine(spark).collect()}
    assert len(held) == 4
    assert held["tomorrow"][L.ATTEMPTS] == 1
    assert held["tomorrow"][L.REPROCESSED_AT] == day2.run_ts
    assert held["next year"][L.ATTEMPTS] == 0 and held["next year"][L.REPROCESSED_AT] is None
    assert reprocess(spark, job(lake, dt.date(2025, 6, 1))) == 1
    assert entities(lake.silver.read(spark)) == ["next year", "sound", "tomorrow"]


def test_reprocess_survives_a_crash_before_the_attempts_are_logged(spark, lake, mixed_csv):
    refine(spark, job(lake), mixed_csv)
    day2 = job(lake, dt.date(2024, 6, 2))
    held = lake.quarantine.read(spark)
    movable = held.filter(day2.rules.full(held, day2.as_of).passed)
    lake.silver.append(_as_silver(spark, lake, movable))
    assert lake.attempts.read_or_none(spark) is None
    assert reprocess(spark, day2) == 0
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]
    attempts = {r["Entidad"]: r[L.ATTEMPTS] for r in lake.read_quarantine(spark).collect()}
    assert attempts == {"tomorrow": 1, "next year": 0, "no price": 0, "no date": 0}
    assert _settled_ids(spark, lake).distinct().count() == 1


def test_repeated_runs_with_a_row_key(spark, lake, mixed_csv):
    key = ["Entidad", "Fecha_de_Firma"]
    refine(spark, job(lake, row_key=key), mixed_csv)
    out = refine(spark, job(lake, row_key=key), mixed_csv)
    assert (out.total, out.clean, out.quarantine) == (5, 1, 4)
    assert lake.bronze.read(spark).count() == 5
    assert lake.quarantine.read(spark).count() == 4

    # Tomorrow's row enters silver from bronze and is not moved a second time.
    day2 = job(lake, dt.date(2024, 6, 2), row_key=key)
    out = refine(spark, day2, reprocess_quarantine=True)
    assert (out.clean, out.quarantine, out.moved) == (2, 3, 0)
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]


def test_a_run_that_died_is_repeated_whole_with_a_row_key(spark, lake, mixed_csv, monkeypatch):
    keyed = job(lake, row_key=["Entidad"])
    append = Lakehouse.append

    def dies(self, spark, layer, *args, **options):
        if layer == "quarantine":
            raise OSError("driver lost")
        return append(self, spark, layer, *args, **options)

    monkeypatch.setattr(Lakehouse, "append", dies)
    with pytest.raises(OSError, match="driver lost"):
        refine(spark, keyed, mixed_csv)
    monkeypatch.undo()
    out = refine(spark, keyed, mixed_csv)
    assert (out.total, out.clean, out.quarantine) == (5, 1, 4)
    assert lake.bronze.read(spark).count() == 5
    assert lake.quarantine.read(spark).count() == 4


def write_csv(path, *rows):
    lines = [contract_line(*r) for r in rows]
    path.write_text("\n".join([",".join(HEADER), *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_rows_that_share_a_key_are_all_kept(spark, lake, tmp_path):
    """A key that is neither unique nor always there, and a delivery that comes again."""
    one = write_csv(tmp_path / "1.csv", ("a", "X", "2024-01-01", "1"), ("a", "X", "", "2"))
    two = write_csv(
        tmp_path / "2.csv", ("a", "X", "2024-01-01", "3"), ("a", "X", "", "4"), ("a", "Y", "", "2"),
        ("a", "X", "", "2"),
    )
    keyed = job(lake, row_key=["Entidad", "Fecha_de_Firma"])
    for path in (one, two, two, one):
        out = refine(spark, keyed, path)
    assert (out.total, out.clean, out.quarantine) == (5, 2, 3)
    assert lake.bronze.read(spark).count() == 5 and lake.quarantine.read(spark).count() == 3
    assert lake.bronze.complete(spark) and lake.quarantine.complete(spark)
    ids = lake.quarantine.read(spark).select(L.QUARANTINE_ID)
    assert ids.distinct().count() == 3
    balance = layer_balance(commit_metrics(spark, lake.commit_logs())).first()
    assert (balance["silver_rows"], balance["quarantine_rows"], balance["valid_pct"]) == (2, 3, 40.0)


def test_a_corrected_delivery_arrives(spark, lake, tmp_path):
    keyed = job(lake, row_key=["Entidad"])
    refine(spark, keyed, write_csv(tmp_path / "1.csv", ("a", "X", "2024-01-01", "-5")))
    refine(spark, keyed, write_csv(tmp_path / "2.csv", ("a", "X", "2024-01-01", "5")))
    assert [r["Precio_Base"] for r in lake.silver.read(spark).collect()] == [5.0]
    assert [r["Precio_Base"] for r in lake.quarantine.read(spark).collect()] == [-5.0]


@pytest.mark.parametrize("key", [None, ["Entidad"]])
def test_reprocess_moves_different_rows_of_a_key(spark, lake, tmp_path, key):
    refine(
        spark, job(lake, row_key=key),
        write_csv(tmp_path / "1.csv", ("a", "X", "2024-06-02", "100"), ("a", "X", "2024-06-02", "200")),
    )
    day2 = job(lake, dt.date(2024, 6, 2), row_key=key)
    assert [reprocess(spark, day2) for _ in range(2)] == [2, 0]
    assert sorted(r["Precio_Base"] for r in lake.silver.read(spark).collect()) == [100.0, 200.0]


def test_a_later_run_without_a_key_doubles_nothing(spark, lake, mixed_csv):
    refine(spark, job(lake), mixed_csv)
    out = refine(spark, job(lake, dt.date(2024, 6, 2)), reprocess_quarantine=True)
    assert (out.clean, out.moved) == (2, 0)
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]


def test_a_new_column_passes_through_all_layers(spark, any_lake, tmp_path):
    lake = any_lake
    refine(spark, job(lake, once=True), write_csv(tmp_path / "1.csv", ("a", "X", "2024-01-01", "1")))
    lines = [",".join([*HEADER, "Nueva Columna"])]
    lines += [contract_line(e, "X", "2024-01-01", p) + ",new" for e, p in (("b", "2"), ("c", "-1"))]
    path = tmp_path / "2.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    out = refine(spark, job(lake, once=True), str(path))
    assert (out.total, out.clean, out.quarantine) == (3, 2, 1)
    new = {r["Entidad"]: r["Nueva_Columna"] for r in lake.silver.read(spark).collect()}
    assert new == {"a": None, "b": "new"}
    assert lake.quarantine.read(spark).first()["Nueva_Columna"] == "new"
    # The first file again, now that the table is wider: its rows are known.
    out = refine(spark, job(lake, once=True), str(tmp_path / "1.csv"))
    assert out.total == 3


def test_a_match_scans_the_digests_of_bronze_and_nothing_else(spark, lake, mixed_csv):
    refine(spark, job(lake, once=True), mixed_csv)
    rows = with_identity(read_contracts(spark, mixed_csv))
    stored = _identified(spark, lake.bronze)
    present = stored.select(L.ROW_DIGEST).join(F.broadcast(rows.select(L.ROW_DIGEST)), L.ROW_DIGEST)
    scan = [x for x in plan_of(present).splitlines() if "FileScan parquet" in x]
    assert len(scan) == 1 and f"ReadSchema: struct<{L.ROW_DIGEST}:string>" in scan[0]
    with Scratch(spark) as scratch:
        assert beyond(scratch, rows, 5, stored).count() == 0
        twice = rows.unionAll(rows).unionAll(rows.filter("Entidad = 'sound'"))
        got = beyond(scratch, twice, 11, stored)
        assert got.columns == rows.columns
        assert entities(got) == sorted(["sound", *entities(rows)])


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_digest_are_given_one_for_good(spark, tmp_path, mixed_csv):
    lake = Lakehouse(str(tmp_path / "old"), contract=CONTRACT_SCHEMA)
    ingest_snapshot(spark, lake, mixed_csv)
    ingest(spark, job(lake), mixed_csv)
    writes = lake.bronze.writes(spark)
    assert len(writes) == 2 and not lake.bronze.complete(spark)
    out = refine(spark, job(lake, once=True), mixed_csv)
    assert out.total == 10 and lake.bronze.complete(spark)
    assert lake.bronze.writes(spark) == writes
    assert lake.bronze.read(spark).filter(F.col(L.ROW_DIGEST).isNull()).isEmpty()


def test_a_key_given_later_moves_one_of_several_copies(spark, lake, mixed_csv):
    refine(spark, job(lake), mixed_csv)
    refine(spark, job(lake))
    assert lake.quarantine.read(spark).count() == 8
    day2 = job(lake, dt.date(2024, 6, 2), row_key=["Entidad"])
    assert [reprocess(spark, day2) for _ in range(2)] == [1, 0]
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]


def test_moved_corrections_outlive_the_next_run(spark, any_lake, mixed_csv):
    lake = any_lake
    key = ["Entidad"]
    refine(spark, job(lake, row_key=key), mixed_csv)
    # Someone corrects a price in quarantine.
    fixed = [
        r.asDict() | ({"Precio_Base": 40} if r["Entidad"] == "no price" else {})
        for r in lake.quarantine.read(spark).collect()
    ]
    schema = lake.quarantine.read(spark).schema
    if schema["Precio_Base"].dataType.simpleString() == "double":
        fixed = [r | {"Precio_Base": r["Precio_Base"] and float(r["Precio_Base"])} for r in fixed]
    lake.quarantine.overwrite(spark.createDataFrame(fixed, schema))

    assert reprocess(spark, job(lake, row_key=key)) == 1
    for day in (DAY1, dt.date(2024, 6, 2)):
        out = refine(spark, job(lake, day, row_key=key), reprocess_quarantine=True)
        assert out.total == 5 and out.moved == 0
        names = entities(lake.silver.read(spark))
        assert names == sorted({"sound", "no price"} | ({"tomorrow"} if day > DAY1 else set()))
    held = {r["Entidad"]: r[L.ATTEMPTS] for r in lake.read_quarantine(spark).collect()}
    assert held["no price"] == 1 and sum(held.values()) == 1


def test_lineage_columns_arrive_after_snapshot_files(spark, tmp_path, mixed_csv):
    lake = Lakehouse(str(tmp_path / "evolving"), contract=CONTRACT_SCHEMA)
    ingest_snapshot(spark, lake, mixed_csv)
    ingest(spark, job(lake), mixed_csv)
    bronze = lake.bronze.read(spark)
    assert bronze.count() == 10
    assert bronze.filter(F.col(L.INGESTED_AT).isNull()).count() == 5


def test_reports_by_catalog_name(spark, tmp_path, mixed_csv):
    lake = Lakehouse(str(tmp_path / "named"), table="by_name", contract=CONTRACT_SCHEMA)
    refine(spark, job(lake), mixed_csv)
    assert lake.register(spark) == [
        "`bronze`.`by_name`",
        "`silver`.`by_name`",
        "`quarantine`.`by_name_errors`",
    ]
    out = spark.sql(
        f"select {L.CODE} c, count(*) n from quarantine.by_name_errors"
        f" where {L.VALIDATED_AT} >= date'2024-05-30' - interval 30 days group by 1"
    )
    assert {tuple(r) for r in out.collect()} == {("E001", 1), ("E002", 2), ("E003", 1)}
    with pytest.raises(ValueError, match="already"):
        lake.register(spark)
    assert len(lake.register(spark, replace=True)) == 3
    assert lake.silver.read(spark).count() == 1


def test_all_copies_of_equal_rows_are_moved_and_stay(spark, any_lake, tmp_path):
    row = ("a", "X", "2024-06-02", "100")
    path = write_csv(tmp_path / "1.csv", row, row, ("b", "X", "2024-01-01", "1"))
    day2 = job(any_lake, dt.date(2024, 6, 2))
    for _ in range(2):  # the second run rejects both again
        refine(spark, job(any_lake), path if _ == 0 else None)
    assert any_lake.quarantine.read(spark).count() == 4
    assert [reprocess(spark, day2) for _ in range(2)] == [2, 0]
    moved = entities(any_lake.silver.read(spark))
    refine(spark, day2, reprocess_quarantine=True)
    assert entities(any_lake.silver.read(spark)) == moved == ["a", "a", "b"]


def test_a_move_that_died_half_way_is_completed(spark, lake, tmp_path):
    row = ("a", "X", "2024-06-02", "100")
    refine(spark, job(lake), write_csv(tmp_path / "1.csv", row, row, row))
    day2 = job(lake, dt.date(2024, 6, 2))
    lake.silver.append(_as_silver(spark, lake, lake.quarantine.read(spark).limit(1)))
    assert [reprocess(spark, day2) for _ in range(2)] == [2, 0]
    attempts = [r[L.ATTEMPTS] for r in lake.read_quarantine(spark).collect()]
    assert attempts == [1, 1, 1]


@pytest.mark.parametrize("once", [False, True])
def test_equal_rows_of_a_delivery_are_kept(spark, lake, tmp_path, once):
    good, bad = ("a", "X", "2024-01-01", "1"), ("b", "X", "", "2")
    path = write_csv(tmp_path / "1.csv", good, good, bad, bad)
    out = refine(spark, job(lake, once=once), path)
    assert (out.total, out.clean, out.quarantine) == (4, 2, 2)
    if once:
        again = write_csv(tmp_path / "2.csv", good, good, good, bad)
        out = refine(spark, job(lake, once=once), again)
        assert (out.total, out.clean, out.quarantine) == (5, 3, 2)
        ids = lake.quarantine.read(spark).select(L.QUARANTINE_ID)
        assert ids.count() == ids.distinct().count() == 2


def test_a_run_over_what_is_new_equals_a_full_one(spark, tmp_path, mixed_csv):
    more = write_csv(tmp_path / "2.csv", ("later", "X", "2024-05-05", "1"), ("broke", "X", "2024-05-05", "-1"))
    lakes = [Lakehouse(str(tmp_path / n), contract=CONTRACT_SCHEMA) for n in ("full", "new")]
    got = []
    for lake, new in zip(lakes, (False, True), strict=True):
        for path, day in ((mixed_csv, DAY1), (more, DAY1), (None, dt.date(2024, 6, 2))):
            out = refine(spark, job(lake, day, once=True), path, True, new_only=new)
        got.append((entities(lake.silver.read(spark)), entities(lake.quarantine.read(spark))))
    assert got[0] == got[1] == (
        ["later", "sound", "tomorrow"], ["broke", "next year", "no date", "no price", "tomorrow"],
    )
    assert (out.total, out.moved) == (0, 1)
    held = {r["Entidad"]: r[L.DUE_ON] for r in lakes[1].quarantine.read(spark).collect()}
    assert held["next year"] == dt.date(2025, 6, 1) and held["no date"] is None
    # What was gated before is not read: its folders are left out by name.
    lake = lakes[1]
    first, last = lake.bronze.writes(spark)
    plan = plan_of(lake.bronze.read(spark, writes=True).filter(F.col("_write").isin([last])))
    assert "PartitionFilters: [isnotnull(_write" in plan
    files_read = lake.bronze.read(spark, writes=True).filter(F.col("_write") == last)
    assert all(f"_write={last}" in f[0] for f in files_read.select("_metadata.file_path").distinct().collect())


def test_new_rows_gated_twice_are_stored_once(spark, lake, mixed_csv, monkeypatch):
    ingest(spark, job(lake), mixed_csv)
    take = Table.take
    monkeypatch.setattr(Table, "take", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError, match="driver lost"):
        refine(spark, job(lake), new_only=True)
    monkeypatch.setattr(Table, "take", take)
    # Judged a day later, one row more is clean; it is not in quarantine as well.
    out = refine(spark, job(lake, dt.date(2024, 6, 2)), new_only=True)
    assert (out.total, out.clean, out.quarantine) == (5, 2, 3)
    assert lake.silver.read(spark).count() == 2 and lake.quarantine.read(spark).count() == 3
    assert refine(spark, job(lake), new_only=True).total == 0


def test_silver_outlives_a_run_that_dies_while_it_is_replaced(spark, lake, mixed_csv):
    refine(spark, job(lake), mixed_csv)
    silver = lake.silver.read(spark)
    broken = silver.withColumn("Entidad", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        lake.silver.overwrite(broken)
    assert entities(lake.silver.read(spark)) == ["sound"]
    lake.silver.overwrite(lake.silver.read(spark).withColumn("Entidad", F.lit("new")))
    assert entities(lake.silver.read(spark)) == ["new"]
    # A reader that had begun still finds what it was reading.
    assert entities(silver) == ["sound"]


def test_reports_read_the_days_they_need(spark, lake, mixed_csv):
    for day in (DAY1, dt.date(2024, 7, 20)):
        refine(spark, job(lake, day), mixed_csv)
    held = lake.quarantine.read(spark)
    report = top_reasons(held, dt.date(2024, 7, 21))
    assert "PartitionFilters: [" in plan_of(report) and f"{L.VALIDATED_ON}" in plan_of(report)
    recent = held.filter(F.col(L.VALIDATED_ON) >= dt.date(2024, 6, 21))
    files_read = recent.select("_metadata.file_path").distinct().collect()
    assert files_read and all(f"{L.VALIDATED_ON}=2024-07-20" in f[0] for f in files_read)
    assert sum(r["cnt"] for r in report.collect()) == 6


def test_a_path_with_quotes_and_two_lakehouses_in_one_catalog(spark, tmp_path, mixed_csv):
    lakes = [Lakehouse(str(tmp_path / f"it's `{n}`"), "quoted", contract=CONTRACT_SCHEMA) for n in "ab"]
    for lake in (*lakes, lakes[1]):
        refine(spark, job(lake), mixed_csv)
    found = [lake.register(spark, namespace=f"lake_{i}") for i, lake in enumerate(lakes)]
    counts = [spark.sql(f"select count(*) from {names[0]}").first()[0] for names in found]
    assert counts == [5, 10] and found[0][0] == "`lake_0_bronze`.`quoted`"


def test_both_sides_come_from_one_scan(spark, lake, mixed_csv, caplog):
    ingest(spark, job(lake), mixed_csv)
    seen = []
    write = tables._deal
    tables._deal = lambda df, *options: (seen.append(plan_of(df)), write(df, *options))
    try:
        with caplog.at_level("INFO", "decantry.plans.runs"):
            out = refine(spark, job(lake))
    finally:
        tables._deal = write
    assert (out.total, out.clean, out.quarantine) == (5, 1, 4)
    assert "E001 1, E002 2, E003 1" in caplog.text
    # One job reads bronze; what it has set apart is gone when it is in quarantine.
    assert len(seen) == 1 and seen[0].count("FileScan") == 1 and "Sort" not in seen[0]
    folder = Path(lake.silver.folder(spark))
    assert folder.name == "_side=kept" and [p.name for p in folder.parent.iterdir() if p.is_dir()] == [folder.name]
    only_bad = write_csv(Path(lake.root).parent / "bad.csv", ("x", "A", "", "1"))
    other = Lakehouse(lake.root + "2", contract=CONTRACT_SCHEMA)
    assert refine(spark, job(other), only_bad).clean == 0
    assert other.silver.read(spark).count() == 0 and other.quarantine.read(spark).count() == 1


def test_gold_reads_what_is_new_in_silver(spark, lake, tmp_path):
    later = job(lake, dt.date(2024, 6, 2))
    rows = [("a", "N", "2024-01-01", "1"), ("b", "S", "2024-06-02", "10"), ("c", "", "2024-01-01", "5")]
    for i, row in enumerate(rows):
        ingest(spark, job(lake), write_csv(tmp_path / f"{i}.csv", row))
        refine(spark, job(lake), new_only=True)
        refresh_gold(spark, job(lake), by_parts=True)
    parts = lake.gold_parts(L.DEPARTMENT, "Precio_Base")
    before = parts.writes(spark)
    assert len(before) == 2
    reprocess(spark, later, due_only=True)
    refresh_gold(spark, later, by_parts=True)
    assert set(before) < set(parts.writes(spark)) and len(parts.writes(spark)) == 3
    totals = {r[0]: r[1] for r in lake.gold.read(spark).collect()}
    assert totals == {"N": 1.0, "S": 10.0, None: 5.0}
    # Silver rebuilt, with a row replaced under the name of its write.
    refine(spark, later)
    lake.silver.append(lake.silver.read(spark).limit(0).unionByName(lake.silver.read(spark).filter("Entidad = 'a'")))
    refresh_gold(spark, later, by_parts=True)
    assert {r[0]: r[1] for r in lake.gold.read(spark).collect()} == {"N": 2.0, "S": 10.0, None: 5.0}
    assert not set(before) & set(parts.writes(spark))


@pytest.mark.parametrize("once", [False, True])
def test_rejects_of_a_run_that_dies_reach_quarantine(spark, lake, mixed_csv, monkeypatch, once):
    ingest(spark, job(lake, once=once), mixed_csv)
    monkeypatch.setattr(Table, "_switch", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError, match="driver lost"):
        refine(spark, job(lake, once=once))
    monkeypatch.undo()
    out = refine(spark, job(lake, once=once), new_only=True)
    assert (out.total, out.clean) == (5, 1)
    held = entities(lake.quarantine.read(spark))
    assert set(held) == {"next year", "no date", "no price", "tomorrow"}
    assert reprocess(spark, job(lake, dt.date(2024, 6, 2))) == 1
    assert entities(lake.silver.read(spark)) == ["sound", "tomorrow"]
