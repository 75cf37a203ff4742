"""The snapshot variant: every layer is replaced, and rejects carry one reason."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from ..operators.gate import clean, with_reason
from ..sources.contracts import read_contracts
from .lakehouse import Lakehouse
from .runs import Rules


def ingest_snapshot(spark: SparkSession, lake: Lakehouse, input_path: str) -> int:
    """Replace bronze by the file as it is, without lineage columns."""
    rows = read_contracts(spark, input_path, lake.contract)
    return replace(lake, snapshot=True).overwrite(spark, "bronze", rows)


def refine_simple(
    spark: SparkSession, lake: Lakehouse, rules: Rules | None = None
) -> tuple[int, int]:
    """Replace silver and quarantine; returns the rows of each.

    A date after today is accepted here.
    """
    lake = replace(lake, snapshot=True)
    bronze = lake.bronze.read(spark)
    checks = (rules or Rules()).simple(bronze)
    return (
        lake.overwrite(spark, "silver", clean(bronze, checks)),
        lake.overwrite(spark, "quarantine", with_reason(bronze, checks), compact=True),
    )
