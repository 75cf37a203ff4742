"""A training corpus from raw documents: five operators one after another.

Each stage works on all that the one before it kept, written as Parquet and read again.
All but the last return the columns of ``documents``, whatever further ones they have;
``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decantry.llm import line_dedup, line_quality, ngram_join, packing, substring
from decantry.llm.common import free_name, table
from decantry.llm.queries import BPE_JSON, ship, vocabulary
from decantry.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame, changed: str, columns: list[str]) -> DataFrame:
    """``columns``, with the length of texts that have changed."""
    if "n_chars" in columns:
        new = F.length("text").cast(docs.schema["n_chars"].dataType)
        docs = docs.withColumn("n_chars", F.when(F.col(changed) > 0, new).otherwise(F.col("n_chars")))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that their host repeats above the limits go, and documents that the rules reject."""
    ship(spark)
    words = free_name("n_boilerplate_words", docs)
    # The limits are of all documents, those that are rejected as well.
    return _counted(line_quality.cleaned(docs, n_removed=words), words, docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents have go from all but the largest id; no row does."""
    ship(spark)
    lines, dropped = free_name("n_lines", docs), free_name("n_dropped", docs)
    left = line_dedup.drop_lines(docs, line_dedup.line_keeps(docs), n_lines=lines, n_dropped=dropped)
    return _counted(left, dropped, docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates stays."""
    ship(spark)
    return ngram_join.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller id has go; no row does."""
    ship(spark)
    removed = free_name("n_removed", docs)
    left = substring.drop_windows(docs, substring.repeated_windows(docs), n_removed=removed)
    return _counted(left, removed, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    ship(spark)
    return packing.pack(docs, vocabulary(BPE_JSON), size=1024, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

# Token ids are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = work_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
