"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores of the local session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from decantry.session import local_session  # noqa: E402
from decantry.workload import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("decantry-bench", cpus)
    spark.sparkContext.setLogLevel("OFF")

    def seconds_of(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    # Loading and compiling Spark's own classes is not part of any query: a scan, a join
    # and an aggregate that are not among them go first.
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    warm = lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy("p_brand").count()
    warm.write.format("noop").mode("overwrite").save()
    seconds = {name: seconds_of(name) for name in sorted(QUERIES)}

    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
