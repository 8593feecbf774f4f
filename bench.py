"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge import build_session
from tidegauge.plans.queries import QUERIES

HEADLINE = (
    "zscore_anomalies",
    "scored_rows",
    "window_stats",
    "sliding_peak_anomalies",
    "offline_stats",
    "thresholds",
    "threshold_scored",
    "window_features",
    "ewma_scores",
    "metric_lines",
    "parse_messages_lenient",
    "normalize_rest",
    "normalize_mqtt",
    "alert_lines",
    "top_devices_24h",
    "before_after_maintenance",
    "stream_window_stats",
    "stream_archive",
    "stream_zscore",
)


def seconds(run, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        run_all(scratch)


def run_all(scratch: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": scratch,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the executors and compile the scan before anything is timed
    seconds(QUERIES["window_stats"], spark, sf_dir)
    times = {}
    for name in HEADLINE:
        repeats = 1 if name.startswith("stream_") else 2
        times[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
