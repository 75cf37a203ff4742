"""Session settings, and the shared folder for tables that live as long as a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import files

# Settings the plans count on. Partition numbers are left to adaptive execution,
# which starts from many small shuffle partitions and merges them by size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}

# Parquet files are written so: half of a row's bytes are digests, and their letters take
# half as much room as under the default, which does not code single letters.
COMPRESSION = "zstd"

# On a cluster. Large splits, since most scans read a few columns; and shuffles of
# moderate width, since the driver tracks every pair of map task and partition. Runs
# with a row key over very many rows want more partitions.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.files.maxPartitionBytes": "512m",
}


def cluster_session(app_name: str) -> SparkSession:
    """Session for ``spark-submit``, whose options go before the settings above."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in CLUSTER_SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(app_name: str, cpus: int | str = "*", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder path that every executor can reach.

    It lies in the folder the cluster names for checkpoints. Only a session that
    runs on one machine may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="decantry-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


class Scratch:
    """Tables that live as long as a step: each is computed once, and none is left behind.

    They are written to the shared folder, so a lost executor takes nothing with it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folders: list[str] = []

    def keep(self, df: DataFrame, *conditions: Column) -> tuple[DataFrame, int, ...]:
        """``df`` as it is stored, its number of rows, and how many of them meet each
        condition."""
        folder, written = work_folder(self.spark), Observation()
        self.folders.append(folder)
        counts = [F.count(F.lit(1)), *(F.count_if(c) for c in conditions)]
        df = df.observe(written, *(c.alias(f"n{i}") for i, c in enumerate(counts)))
        df.write.parquet(folder, compression=COMPRESSION)
        got = written.get
        stored = self.spark.read.schema(df.schema).parquet(folder)
        return stored, *(got[f"n{i}"] for i in range(len(counts)))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for folder in self.folders:
            files.delete(self.spark, folder)


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """A frame of one row that needs neither a job nor a Python worker to make."""
    return spark.sql("SELECT 1").select(*(c.alias(name) for name, c in columns.items()))
