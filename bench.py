"""Time the headline queries on the local machine and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local
cores, BENCH_QUERIES (comma separated, or ``all``) overrides the selection. Every
result is written in full to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from delayengine.plans.queries import QUERIES

HEADLINE = (
    "by_route", "by_carrier", "by_hour", "stats_grouping_sets", "route_features", "clean_flights",
    "flights_partitioned", "csv_roundtrip", "quality_report", "temporal_features", "training_rows",
    "class_balance", "state_enriched", "latest_state", "live_expired", "states_json_parsed",
    "state_vectors", "normalized_flights", "api_live_records", "density", "congestion_risk", "kpis",
    "activity_trend", "delay_histogram", "delays_top", "model_metrics", "scored_flights",
    "stream_latest_state", "stream_density",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["by_carrier"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    taken = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {taken[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
