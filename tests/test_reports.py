import datetime as dt

import pytest
from pyspark.sql import functions as F

from decantry import labels as L
from decantry.operators import (
    daily_rejects,
    group_totals,
    layer_balance,
    layer_comparison,
    reason_counts,
    recent_invalid,
    reject_pct_by_day,
    sample_rejects,
    top_groups,
    top_reasons,
    with_attempts,
)

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="module")
def rejects(spark):
    rows = [
        ("1", "r1", "E001", "2024-06-30 23:00:00"),
        ("2", "r1", "E001", "2024-06-30 01:00:00"),
        ("3", "r2", "E002", "2024-06-29 00:00:00"),
        ("4", "r3", "E999", "2024-06-29 00:00:00"),
        ("5", "r0", "E004", "2024-05-31 00:00:00"),
        ("6", "r4", "E003", "2024-05-30 23:59:59"),
    ]
    text = f"{L.QUARANTINE_ID} string, {L.REJECT_REASON} string, {L.CODE} string, at string"
    return (
        spark.createDataFrame(rows, text)
        .withColumn(L.VALIDATED_AT, F.to_timestamp("at"))
        .withColumns({L.ENTITY: F.lit("e"), L.PRICE: F.lit(1.0), L.SIGNED_ON: F.lit(AS_OF)})
        .drop("at")
    )


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_daily_rejects(rejects):
    out = daily_rejects(rejects)
    assert out.columns[1:] == ["total_quarantined", *L.REPORT_CODES]
    assert tuples(out) == [
        (dt.date(2024, 6, 30), 2, 2, 0, 0, 0),
        (dt.date(2024, 6, 29), 2, 0, 1, 0, 0),
        (dt.date(2024, 5, 31), 1, 0, 0, 0, 1),
        (dt.date(2024, 5, 30), 1, 0, 0, 1, 0),
    ]


def test_reject_pct_keeps_days_with_rejects_only(spark, rejects):
    silver = spark.sql(
        f"select to_timestamp(t) as {L.INGESTED_AT} from values"
        " ('2024-06-30 05:00:00'), ('2024-06-01 00:00:00'), (null) as v(t)"
    )
    assert tuples(reject_pct_by_day(rejects, silver)) == [
        (dt.date(2024, 6, 30), 2, 1, 66.67),
        (dt.date(2024, 6, 29), 2, 0, 100.0),
        (dt.date(2024, 5, 31), 1, 0, 100.0),
        (dt.date(2024, 5, 30), 1, 0, 100.0),
    ]


def test_top_reasons_of_the_last_days(rejects):
    assert tuples(top_reasons(rejects, AS_OF)) == [("r1", 2), ("r0", 1), ("r2", 1), ("r3", 1)]
    assert tuples(top_reasons(rejects, AS_OF, n=2)) == [("r1", 2), ("r0", 1)]
    assert tuples(top_reasons(rejects, AS_OF, days=1)) == [("r1", 2), ("r2", 1), ("r3", 1)]


def test_recent_invalid_breaks_ties_by_id(rejects):
    out = recent_invalid(rejects, n=3)
    assert out.columns == [L.ENTITY, L.PRICE, L.SIGNED_ON, L.REJECT_REASON, L.VALIDATED_AT]
    assert [r[L.REJECT_REASON] for r in out.collect()] == ["r1", "r1", "r2"]
    assert recent_invalid(rejects, entity="entidad").count() == 6  # names ignore case
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_reason_counts_and_sample(rejects):
    assert sorted(tuples(reason_counts(rejects))) == [
        ("r0", 1), ("r1", 2), ("r2", 1), ("r3", 1), ("r4", 1)
    ]
    assert sample_rejects(rejects, n=4).count() == 4


def test_gold_has_a_group_for_rows_without_one(spark):
    df = spark.createDataFrame(
        [("a", 5), ("a", 6), (None, 20), ("b", 11), ("c", None), ("d", 1)], "g string, v bigint"
    )
    assert tuples(top_groups(df, "g", "v", n=4)) == [
        (None, 20.0), ("a", 11.0), ("b", 11.0), ("d", 1.0)
    ]
    assert dict(tuples(group_totals(df, "g", "v")))["c"] is None
    as_text = df.withColumn("v", F.concat(F.col("v").cast("string"), F.lit("x")))
    assert tuples(top_groups(as_text.filter("g = 'a'"), "g", "v")) == [("a", None)]
    exact = df.withColumn("v", F.col("v").cast("decimal(20,2)"))
    assert group_totals(exact, "g", "v").schema["total_contratado"].dataType.typeName() == "decimal"


def test_gold_reads_two_columns_and_aggregates_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    spark.range(10).selectExpr("id as g", "id as v", "id as unused").write.parquet(path)
    plan = (
        top_groups(spark.read.parquet(path), "g", "v")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "ReadSchema: struct<g:bigint,v:bigint>" in plan
    assert plan.index("partial_sum") > plan.index("Exchange")
    assert plan.count("Exchange") == 1 and "TakeOrderedAndProject" in plan


def test_balance_of_empty_layers(spark):
    text = "table_set string, layer string, judged bigint, bytes bigint"
    metrics = spark.createDataFrame(
        [("t", "bronze", 0, None), ("t", "silver", 0, None), ("u", "silver", 2, 1),
         ("u", "quarantine", 1, 1)],
        text,
    )
    balance = {r["table_set"]: r for r in layer_balance(metrics).collect()}
    assert (balance["t"]["valid_pct"], balance["t"]["rejected_pct"]) == (0.0, 0.0)
    assert (balance["u"]["valid_pct"], balance["u"]["rejected_pct"]) == (66.7, 33.3)
    assert balance["t"]["silver_bytes"] is None
    assert (balance["u"]["silver_bytes"], balance["u"]["quarantine_bytes"]) == (1, 1)
    assert sorted(tuples(layer_comparison(metrics))) == [("t", 0, 0), ("u", 2, 1)]


def test_attempts_fold_in(spark):
    held = spark.createDataFrame(
        [("q1", 0), ("q2", 3)], f"{L.QUARANTINE_ID} string, {L.ATTEMPTS} int"
    )
    assert [r[L.REPROCESSED_AT] for r in with_attempts(held, None).collect()] == [None, None]
    log = spark.createDataFrame(
        [("q1", dt.datetime(2024, 1, 1)), ("q1", dt.datetime(2024, 1, 2)),
         ("gone", dt.datetime(2024, 1, 3))],
        f"{L.QUARANTINE_ID} string, {L.REPROCESSED_AT} timestamp",
    )
    out = with_attempts(held, log)
    assert out.columns == [L.QUARANTINE_ID, L.ATTEMPTS, L.REPROCESSED_AT]
    assert sorted(tuples(out)) == [("q1", 2, dt.datetime(2024, 1, 2)), ("q2", 3, None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_prune_and_shuffle_aggregates_only(spark, rejects, tmp_path):
    path = str(tmp_path / "quarantine")
    rejects.write.parquet(path)
    stored = spark.read.parquet(path)

    daily = plan_of(daily_rejects(stored))
    assert f"ReadSchema: struct<{L.CODE}:string,{L.VALIDATED_AT}:timestamp>" in daily
    # One shuffle of per-task counts, one to order the days.
    assert daily.count("Exchange ") == 2 and "partial_count" in daily

    reasons = plan_of(top_reasons(stored, AS_OF))
    assert f"GreaterThanOrEqual({L.VALIDATED_AT},2024-05-31" in reasons
    assert reasons.count("Exchange ") == 1 and "TakeOrderedAndProject" in reasons

    pct = plan_of(reject_pct_by_day(stored, stored.withColumnRenamed(L.VALIDATED_AT, L.INGESTED_AT)))
    assert pct.count("partial_count") == 2 and pct.count("FileScan") == 2
    assert pct.count(f"ReadSchema: struct<{L.VALIDATED_AT}:timestamp>") == 2

