"""Command line of the layered run, for ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from decantry.plans import (
    Lakehouse,
    Refinement,
    ingest_snapshot,
    refine,
    refine_simple,
    refresh_gold,
)
from decantry.plans.runs import Summary
from decantry.session import cluster_session
from decantry.sources import CONTRACT_SCHEMA


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Gate a lakehouse's raw table into its layers.")
    # The names, choices and defaults of these five options are an interface.
    p.add_argument("--input-path", help="delimited file(s) to append to bronze first")
    p.add_argument("--lakehouse-root", default="data/lakehouse", help="folder of the layers")
    p.add_argument("--pipeline-version", default="v1", help="recorded on every rejected row")
    p.add_argument("--mode", choices=["dev", "prod"], default="dev", help="prod alerts")
    p.add_argument("--run-reprocess", action="store_true", help="look at quarantine again")
    p.add_argument("--table", default="contracts", help="table name within the layers")
    p.add_argument("--table-format", default="parquet", help="parquet, or delta with its jars")
    p.add_argument("--gold-table", help="also write the largest groups to this gold table")
    p.add_argument("--once", action="store_true", help="store what is delivered again once")
    p.add_argument("--row-key", help="as --once; columns that the input must have")
    p.add_argument("--new-only", action="store_true", help="gate what is new in bronze, and rejects that are due")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="day to judge dates by")
    p.add_argument("--snapshot", action="store_true", help="replace all layers, simple rules")
    p.add_argument("--infer-schema", action="store_true", help="no contract: types by the data")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> Summary | None:
    lake = Lakehouse(
        args.lakehouse_root,
        args.table,
        args.table_format,
        None if args.infer_schema else CONTRACT_SCHEMA,
        args.gold_table or "top_groups",
        measure_bytes=True,
    )
    job = Refinement(
        lake,
        pipeline_version=args.pipeline_version,
        mode=args.mode,
        row_key=args.row_key.split(",") if args.row_key else None,
        once=args.once,
        as_of=args.as_of,
    )
    if args.snapshot:
        summary = _snapshot(spark, lake, args.input_path)
    else:
        summary = refine(spark, job, args.input_path, args.run_reprocess, args.new_only)
    if summary is not None and args.gold_table:
        refresh_gold(spark, job)
    return summary


def _snapshot(spark: SparkSession, lake: Lakehouse, input_path: str | None) -> Summary:
    if input_path:
        ingest_snapshot(spark, lake, input_path)
    kept, rejected = refine_simple(spark, lake)
    return Summary.of(kept + rejected, kept)


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parse_args(argv)
    spark = cluster_session("decantry")
    try:
        summary = run(spark, args)
    finally:
        spark.stop()
    if summary is None:
        raise SystemExit("there is no bronze table to gate")
    print(summary)


if __name__ == "__main__":
    main()
