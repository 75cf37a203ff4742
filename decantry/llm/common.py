"""Small helpers that several operators share.

A *row* of a document table is told apart by its id and a hash of its text, so that
repeated ids with different texts stay apart and repeated rows count as one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

# White space is the ASCII set of these characters, for words as well as line ends.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words between white space; an empty array for a text without any."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def row_key(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash")]


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    What several later steps read is not computed again for each of them, and a lost
    executor costs only the tasks that were on it.
    """
    spark = df.sparkSession
    path = work_folder(spark)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_unique(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with a table that was aggregated by ``key``.

    The join is on a struct of the key, so that the aggregate is shuffled once more
    rather than joined where it lies. It is small next to ``rows``, and only then can
    adaptive execution split the rows of a hot key over several tasks.
    """
    match = free_name("match", rows, unique)
    return (
        rows.withColumn(match, F.struct(key))
        .join(unique.withColumn(match, F.struct(key)).drop(key), match, how)
        .drop(match)
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, with its partitions and their order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it while one of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_chunks(texts: list[str | None], chars: int = 1 << 19):
    """Slices of the list of about ``chars`` characters each, so that what is worked on
    at a time doesn't grow with the batch. A longer text is a slice of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
