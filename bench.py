"""Headline query timings: prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_REPEAT (default 5: the median run is reported).

Each query runs to completion into the ``noop`` sink, so every row is
computed and nothing is collected. One warm-up pass loads the JVM code paths
first; its time is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cabgrid import entrypoints as ep  # noqa: E402

HEADLINE = [
    "topk_routes",  # Q1
    "window_trip_totals",  # Q1b
    "running_route_trips",
    "rank_routes_with_ties",
    "topk_cells",  # Q2
    "profitability_per_window",  # Q2b
    "empty_cabs",
    "route_daytime_profile",  # Q3
    "cell_daytime_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cabgrid-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t = time.perf_counter()
        ep.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in HEADLINE[:2]:
        run(name)  # warm-up
    times = {name: round(statistics.median(run(name) for _ in range(repeat)), 3) for name in HEADLINE}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
