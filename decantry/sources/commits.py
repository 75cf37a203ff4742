"""What each write did, as data: one JSON record per commit.

Delta tables keep such records in their log directory. For other formats
``CommitLog.record`` writes records of the same shape next to the tables, so
one reader serves both.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..session import one_row

# Only these members are parsed out of a commit file. The names
# are those of Delta commit files, metrics are stored as text there.
_METRICS = (
    T.StructType()
    .add("numOutputRows", "string")
    .add("numOutputBytes", "string")
    .add("numJudgedRows", "string")
)
COMMIT_SCHEMA = T.StructType().add(
    "commitInfo",
    T.StructType()
    .add("timestamp", "long")
    .add("operation", "string")
    .add("operationParameters", T.StructType().add("mode", "string"))
    .add("operationMetrics", _METRICS),
)


@dataclass(frozen=True)
class CommitLog:
    """Where the commit records of one table are."""

    table_set: str
    layer: str
    path: str

    def record(
        self,
        spark: SparkSession,
        mode: str,
        rows: int,
        size: int | None,
        at: dt.datetime | None = None,
        judged: int | None = None,
    ) -> None:
        """``size`` is None where nothing has measured it, ``judged`` where it is ``rows``."""
        at = at or dt.datetime.now(dt.timezone.utc)
        given = {"numOutputRows": rows, "numOutputBytes": size, "numJudgedRows": judged}
        info = {
            "timestamp": int(at.timestamp() * 1000),
            "operation": "WRITE",
            "operationParameters": {"mode": mode},
            "operationMetrics": {k: str(v) for k, v in given.items() if v is not None},
        }
        # The name puts the record in order, as a commit's number does, and is no other
        # writer's.
        name = f"{int(at.timestamp() * 1_000_000):020d}-{uuid.uuid4().hex[:8]}.json"
        files.write_new(spark, f"{self.path}/{name}", json.dumps({"commitInfo": info}) + "\n")

    def last(self, spark: SparkSession) -> str | None:
        """Path of the last commit file, from the folder's listing alone."""
        found = [n for n in files.names(spark, self.path) if n.endswith(".json")]
        return f"{self.path}/{found[-1]}" if found else None


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def commit_metrics(spark: SparkSession, logs: Sequence[CommitLog]) -> DataFrame:
    """Rows and bytes of the last commit of every table.

    Only the last record of each log is read, however long the history. ``judged`` are
    the rows that the commit stands for: more than ``rows`` where it added only new ones.
    A table without log, or whose last commit carries no metrics, has no rows; ``bytes``
    is NULL where they were not measured.
    """
    frames = []
    for log in logs:
        labels = {"table_set": F.lit(log.table_set), "layer": F.lit(log.layer)}
        # A row without commit keeps tables in the result that have no log.
        nothing = F.lit(None).cast(COMMIT_SCHEMA["commitInfo"].dataType)
        frames.append(one_row(spark, commitInfo=nothing, **labels))
        last = log.last(spark)
        if last is not None:
            frames.append(spark.read.schema(COMMIT_SCHEMA).json(last).withColumns(labels))

    def metric(name: str) -> Column:
        return F.max(F.col(f"commitInfo.operationMetrics.{name}").try_cast("bigint"))

    rows = F.coalesce(metric("numOutputRows"), F.lit(0))
    return _union(frames).groupBy("table_set", "layer").agg(
        rows.alias("rows"),
        metric("numOutputBytes").alias("bytes"),
        F.coalesce(metric("numJudgedRows"), rows).alias("judged"),
    )
