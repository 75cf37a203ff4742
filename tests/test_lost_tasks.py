"""Writes whose tasks each fail once, in a session that tries again."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from decantry.session import work_folder
from decantry.sources import Table

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

def lost_once(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("executor lost")

rows = spark.range(0, 4000, 1, 8).mapInPandas(lost_once, "id long")
rows = rows.withColumn("u", F.expr("uuid()"))
for compact in (False, True, "u"):
    table = Table(work_folder(spark))
    written = table.append(rows, compact)
    stored = table.read(spark)
    ids, keys = (stored.select(c).distinct().count() for c in ("id", "u"))
    print("RESULT", written, stored.count(), ids, keys)
"""


def test_rows_and_counts_are_exact_when_tasks_are_lost():
    root = str(Path(__file__).resolve().parents[1])
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT],
        env={**os.environ, "PYTHONPATH": root},
        capture_output=True,
        text=True,
        timeout=180,
        check=True,
    )
    results = [line for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert results == ["RESULT 4000 4000 4000 4000"] * 3
