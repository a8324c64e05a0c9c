"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is forced by a full write to the ``noop`` sink: one warm-up, then the
median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from catalog.queries import QUERIES  # noqa: E402

HEADLINE = [
    "n1_windows", "n7_web", "n11_dispatch", "j1_intel_semi_join", "j2_geo_lookup", "j3_login_pairs",
    "d1_brute_force", "d2_impossible_travel", "d3_suspicious_ip", "d4_privilege_escalation", "d5_unusual_hours",
    "d6_multiple_failed_auth", "d7_all_rules", "a3_hourly_trend", "a8_login_heatmap", "q1_failure_buckets",
    "q2_top_attackers", "q5_severity_chart", "q7_risk_leaderboard", "q10_multi_source_ips", "m1_features", "m2_scores",
    "t2_stream_failure_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", partitions).config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 4)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"), "spark": spark.version, "cpus": cpus,
        "shuffle_partitions": partitions, "driver_memory": "8g", "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
