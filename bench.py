"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every query runs once; building, planning and all
result rows count.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalogue.queries import QUERIES  # noqa: E402

HEADLINES = (
    "publish_replay",
    "gold_monthly", "gold_segments", "gold_alerts",
    "run_counts", "quarantine_rows", "rejection_reasons", "silver_repayments",
    "conflict_flag", "conflict_keys", "ri_orphans", "monthly_ship_trend", "segment_alerts",
    "report_monthly", "segments_latest_month", "rejection_triage", "integrity_report",
    "monthly_from_wide", "reconcile_monthly", "card_monthly", "card_alerts",
    "snapshot_csv",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_success"](spark, sf_dir).collect()  # starts the session
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))


if __name__ == "__main__":
    main()
