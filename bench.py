"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderpulse.queries import QUERIES  # noqa: E402

HEADLINE = (
    "fluctuations_top3", "fluctuations_two_branch", "fluctuations_multi_tag", "fluctuations_sql_top3",
    "fluctuations_backfill", "rank_all", "daily_sum", "orders_with_entity", "filter_trailing_window",
    "company_bridge_initial", "bridge_union_distinct", "customer_industry_dim", "distinct_dim", "merge_upsert",
    "order_json_roundtrip", "scan_table", "sink_append_partitioned", "sink_partition_overwrite",
    "initial_load_counts", "daily_job", "stream_orders_silver", "stream_customers_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        # The first run warms up: it compiles the plan and writes shared inputs.
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median seconds per headline query", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
