"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query (the median counts, after
one warm-up run), BENCH_QUERIES a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.catalog import QUERIES  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

HEADLINE = [
    "fraud_rate_by_type",
    "pivot_dow_hour",
    "sender_profile",
    "device_profile",
    "features_unscaled",
    "scaled_features",
    "validation_status",
    "quarantine",
    "describe_numeric",
    "amount_bands",
    "box_stats_by_type",
    "histogram",
    "velocity_daily",
    "entity_summary",
    "account_age",
    "drift_report",
    "roc_points",
    "evaluation_report",
    "threshold_sweep",
    "knn_minority",
    "smote_counts",
    "stream_velocity",
]


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        timed = []
        for attempt in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
            if attempt:
                timed.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timed), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
