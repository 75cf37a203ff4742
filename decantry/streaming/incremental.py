"""The layered run over files that keep arriving.

A batch run gates all of bronze again. Where that is too much, this run takes
only the files that are new since its last start: the gate looks at one row at a
time, so clean rows and rejects of new files can simply be appended. Rows dated
in the future enter silver by reprocessing once their day has come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import labels as L
from ..plans.runs import Refinement, gate_writes, ingest_rows


def refine_new_files(
    spark: SparkSession,
    job: Refinement,
    input_dir: str,
    checkpoint: str,
    labels: Sequence[str] | None = None,
    max_files: int = 1000,
    delimiter: str = ",",
) -> StreamingQuery:
    """Process the files of ``input_dir`` that are new, then stop.

    Files have the contract's columns in its order, and a header row, which is
    compared with ``labels`` where they are given. Each batch is a write of its own in
    every layer, named after the checkpoint and its number. One that failed half-way is
    delivered again with the same files and replaces what it had stored. Equal rows of one
    file or of several are all kept, unless ``job`` takes each content once.
    """
    contract = job.lake.contract
    if contract is None:
        raise ValueError("a stream needs a contract: its schema cannot follow the data")
    schema = contract
    if labels is not None:
        schema = T.StructType(
            [T.StructField(label, f.dataType) for label, f in zip(labels, contract, strict=True)]
        )
    arriving = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", labels is None)
        .option("sep", delimiter)
        .option("maxFilesPerTrigger", max_files)
        .csv(input_dir)
        .toDF(*contract.names)
        .withColumn(L.SOURCE_FILE, F.col("_metadata.file_path"))
    )
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    return (
        arriving.writeStream.foreachBatch(
            lambda rows, number: append_batch(rows, job, f"stream-{stream}-{number:012d}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_batch(rows: DataFrame, job: Refinement, batch: str) -> None:
    """Append ``rows`` to bronze and, gated, to silver and quarantine, as write ``batch``.

    Silver and quarantine follow from what bronze has taken, so the layers agree whenever
    the batch is repeated. No stored row is read, unless ``job`` takes each content once:
    then the digests of bronze are.
    """
    spark, job = rows.sparkSession, job.opened()
    clock = job.clock(spark)
    if ingest_rows(spark, job, rows, F.col(L.SOURCE_FILE), clock, batch):
        gate_writes(spark, job, [batch], clock)
