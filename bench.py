"""Time the headline queries at one scale factor; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's plan is run to completion with the ``noop`` sink (every
column of every row is produced, nothing is collected). One untimed
warm-up pass of the same queries on the same tables precedes the timed
pass (standard JVM practice: class loading, code generation and JIT
compilation of each plan shape are not counted as query time).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from daybook.plans.catalog import QUERIES  # noqa: E402
from daybook.session import build_session  # noqa: E402

HEADLINE = [
    "feature_table",        # flagship: raw tables → features
    "dedupe_by_key",
    "daily_agg",
    "gapfill_days",
    "gapfill_days_join",
    "feature_check",
    "duplicate_summary",
    "metrics_by_version",
    "champion_challenger",
    "run_summary",
    "csv_ingest",
    "table_roundtrip",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", "daybook-bench", shuffle_partitions=cpus * 2,
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        run(spark, name, sf_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
