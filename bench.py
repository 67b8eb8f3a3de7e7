"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and once for the clock, and is written to the no-op sink, so
every row and column is produced and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from weirgate.catalog import QUERIES
from weirgate.session import RUNTIME_CONF, STREAM_CONF

HEADLINE = (
    "p09_route_counts",
    "validate_errors",
    "v16_valid_rows",
    "d01_ttl_dedup",
    "d03_outcomes",
    "d04_batch_tally",
    "a05_stats_snapshot",
    "a08_latency_percentiles",
    "a10_histogram_quantile",
    "a11_hourly_metrics",
    "a14_rolling_success",
    "w01_event_rate",
    "w02_event_rate_by_type",
    "w04_cumulative_counters",
    "r1_session_windows",
    "r2_event_aggregates",
    "r3_enrichment",
    "r3_transaction_match",
    "r4_anomalies",
    "r5_alerts",
    "r7_throttle",
    "k01_publish_topics",
    "k03_value_encoding",
    "s01_single_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weirgate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    for key, value in {**RUNTIME_CONF, **STREAM_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds: dict[str, float] = {}
    for name in chosen:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
