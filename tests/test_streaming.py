import datetime as dt

import pytest

from decantry import labels as L
from decantry.plans import Lakehouse, Refinement, refine
from decantry.sources import CONTRACT_SCHEMA
from decantry.streaming import append_batch, refine_new_files

from contract_rows import HEADER, contract_line

DAY = dt.date(2024, 6, 1)


def write(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [contract_line(*r) for r in rows]
    (folder / name).write_text("\n".join([",".join(HEADER), *lines]) + "\n", encoding="utf-8")


def job(root, **options):
    lake = Lakehouse(str(root), contract=CONTRACT_SCHEMA)
    return Refinement(lake, as_of=DAY, run_ts=dt.datetime(2024, 6, 1, 12), **options)


def layers(spark, lake):
    return {
        "bronze": sorted(r["Entidad"] for r in lake.bronze.read(spark).collect()),
        "silver": sorted(r["Entidad"] for r in lake.silver.read(spark).collect()),
        "quarantine": sorted(
            (r["Entidad"], r[L.CODE]) for r in lake.quarantine.read(spark).collect()
        ),
    }


def test_new_files_only_and_same_result_as_a_full_run(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write(inbox, "1.csv", ("a", "X", "2024-01-01", "1"), ("b", "X", "2024-01-01", "-1"))
    streamed = job(tmp_path / "streamed")
    checkpoint = str(tmp_path / "checkpoint")
    refine_new_files(spark, streamed, str(inbox), checkpoint).awaitTermination(120)
    write(inbox, "2.csv", ("c", "Y", "2024-02-01", "2"), ("d", "Y", "2025-01-01", "3"))
    for _ in range(2):
        refine_new_files(spark, streamed, str(inbox), checkpoint, HEADER).awaitTermination(120)
    got = layers(spark, streamed.lake)
    assert got == {
        "bronze": ["a", "b", "c", "d"],
        "silver": ["a", "c"],
        "quarantine": [("b", "E004"), ("d", "E002")],
    }
    files = {r[L.SOURCE_FILE].rsplit("/", 1)[1] for r in streamed.lake.bronze.read(spark).collect()}
    assert files == {"1.csv", "2.csv"}

    full = job(tmp_path / "full")
    refine(spark, full, str(inbox))
    assert layers(spark, full.lake) == got


@pytest.mark.parametrize("key", [None, ["Entidad"]])
def test_a_batch_delivered_twice_is_stored_once(spark, tmp_path, key):
    keyed = job(tmp_path / "keyed", row_key=key)
    rows = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 1.0, "f"), ("b", None, 1.0, "f")],
        "Entidad string, Fecha_de_Firma date, Precio_Base double, _source_file string",
    )
    append_batch(rows, keyed, "s-0")
    first = layers(spark, keyed.lake)
    append_batch(rows, keyed, "s-0")
    assert layers(spark, keyed.lake) == first


def test_equal_rows_are_kept_and_a_batch_stored_in_part_is_completed(spark, tmp_path):
    plain = job(tmp_path / "plain")
    schema = "Entidad string, Fecha_de_Firma date, Precio_Base double, _source_file string"
    good, bad = ("a", dt.date(2024, 1, 1), 1.0), ("b", None, 1.0)
    first = spark.createDataFrame([(*r, "f") for r in (good, good, bad, bad)], schema)
    append_batch(first.limit(1), plain, "s-0")
    append_batch(first, plain, "s-0")
    append_batch(first, plain, "s-0")
    once = {"bronze": [*"aabb"], "silver": [*"aa"], "quarantine": [("b", "E001")] * 2}
    assert layers(spark, plain.lake) == once
    append_batch(spark.createDataFrame([(*r, "g") for r in (good, bad)], schema), plain, "s-1")
    got = layers(spark, plain.lake)
    assert got["silver"] == [*"aaa"] and got["quarantine"] == [("b", "E001")] * 3
    held = plain.lake.quarantine.read(spark)
    assert held.select(L.QUARANTINE_ID).distinct().count() == 3


def test_a_stream_needs_a_contract(spark, tmp_path):
    free = Refinement(Lakehouse(str(tmp_path)))
    with pytest.raises(ValueError, match="contract"):
        refine_new_files(spark, free, str(tmp_path), str(tmp_path / "c"))
