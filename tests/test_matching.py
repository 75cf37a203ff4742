import contextlib

import pytest
from pyspark.sql import functions as F

from decantry.operators.matching import without_matches, without_matches_in_large

KEYS = ["a", "b"]


@contextlib.contextmanager
def settings(spark, **values):
    names = {k: k.replace("__", ".") for k in values}
    before = {names[k]: spark.conf.get(names[k], None) for k in values}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("match", [without_matches, without_matches_in_large])
def test_matches_leave_with_all_their_copies(spark, match, limit):
    left = [(1, "x", 0), (1, "x", 1), (1, None, 2), (None, None, 3), (2, "x", 4), (None, "x", 5)]
    right = [(1, "x"), (1, "x"), (None, None), (2, "y"), (3, "x"), (None, "y")]
    df = spark.createDataFrame(left, "a int, b string, n int")
    other = spark.createDataFrame(right, "a int, b string")
    out = match(df, other, KEYS, broadcast_bytes=limit)
    assert out.columns == df.columns
    assert sorted(r["n"] for r in out.collect()) == [2, 4, 5]
    none = match(df, other.filter("a > 99"), KEYS, broadcast_bytes=limit)
    assert none.count() == len(left)


def test_few_keys_are_broadcast_and_nothing_is_shuffled_with_them(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.lit("x").alias("b"), "id")
    out = without_matches(df, df.filter("a = 3"), KEYS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_hot_key_is_spread(spark):
    """Two thirds of the rows share one key, which is unknown to the other side."""
    rows = spark.range(0, 600_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("a"),
        F.lit("x").alias("b"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    other = spark.range(0, 600_000, 2).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1m",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2m",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        out = without_matches(rows, other, KEYS, broadcast_bytes=0)
        per_task = out.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("payload").alias("n"), F.max("payload")
        )
        sizes = [r["n"] for r in per_task.collect()]
        plan = per_task._jdf.queryExecution().executedPlan().toString()
    assert sum(sizes) == 400_000 + 100_000
    assert "SortMergeJoin(skew=true)" in plan, plan
    assert max(sizes) < 200_000
