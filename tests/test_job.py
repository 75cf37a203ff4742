import datetime as dt
from pathlib import Path

import pytest

from decantry.plans.job import parse_args, run
from decantry.plans.lakehouse import Lakehouse
from decantry.session import work_folder
from decantry.sources import commit_metrics


def test_options():
    args = parse_args(["--mode", "prod", "--run-reprocess", "--as-of", "2024-06-01"])
    assert (args.lakehouse_root, args.pipeline_version) == ("data/lakehouse", "v1")
    assert args.mode == "prod" and args.run_reprocess and args.as_of == dt.date(2024, 6, 1)
    with pytest.raises(SystemExit):
        parse_args(["--mode", "test"])


def test_run_from_options(spark, tmp_path, contracts_csv):
    options = ["--lakehouse-root", str(tmp_path), "--mode", "prod", "--run-reprocess",
               "--gold-table", "best", "--pipeline-version", "v9"]
    summary = run(spark, parse_args([*options, "--input-path", contracts_csv]))
    assert (summary.total, summary.clean, summary.alert, summary.moved) == (12, 7, True, 0)
    lake = Lakehouse(str(tmp_path), gold_table="best")
    assert lake.gold.read(spark).count() == 6
    versions = lake.quarantine.read(spark).select("_pipeline_version").distinct().collect()
    assert [r[0] for r in versions] == ["v9"]
    sizes = {r["layer"]: r["bytes"] for r in commit_metrics(spark, lake.commit_logs()).collect()}
    for layer in ("bronze", "quarantine"):  # silver's last commit is what was moved: nothing
        files = Path(getattr(lake, layer).path).rglob("*.parquet")
        assert sizes[layer] == sum(f.stat().st_size for f in files)


def test_run_without_bronze(spark, tmp_path):
    assert run(spark, parse_args(["--lakehouse-root", str(tmp_path)])) is None


def test_work_folders_are_new_and_follow_the_checkpoint_setting(spark):
    first, second = work_folder(spark), work_folder(spark)
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert first.startswith(shared.rstrip("/"))


def test_snapshot_from_options(spark, tmp_path, contracts_csv):
    options = ["--lakehouse-root", str(tmp_path), "--snapshot", "--input-path", contracts_csv]
    for _ in range(2):
        summary = run(spark, parse_args(options))
        assert (summary.total, summary.clean, summary.quarantine) == (12, 8, 4)
        assert not summary.alert
