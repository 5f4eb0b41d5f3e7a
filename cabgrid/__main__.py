"""Command line: ``spark-submit -m cabgrid <job> ...`` or ``python -m cabgrid <job> ...``.

    frequent-routes   TRIPS OUT_DIR [--k 10] [--length ... [--slide ...]] [--semantics observed] [--input-format csv|parquet]
    profitable-areas  TRIPS OUT_DIR [--k 10] [--length ... [--slide ...]] [--semantics observed] [--input-format csv|parquet]
    daytime-profile   TRIPS OUT_DIR [--k 10] [--length ... [--slide ...]] [--semantics observed] [--input-format csv|parquet]
    prepare           TRIP_DIR FARE_DIR OUT_DIR [--rows-per-file N] [--output-format csv|parquet]
    stream-routes     IN_DIR OUT_DIR CHECKPOINT [--k 10] [--max-files-per-trigger N] [--interval "3 seconds"]
                      [--max-bytes-per-trigger 512m] [--length "30 minutes"] [--watermark "30 minutes" | --no-watermark]
    stream-open       CHECKPOINT OUT_DIR [--k 10]   (a finite input ended: the windows still open, from the state)

The session comes from ``spark-submit``/``spark-defaults.conf`` (master,
memory, ``spark.checkpoint.dir``); nothing here is hard-coded.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from cabgrid.operators.areas import AREA_WINDOW
from cabgrid.operators.routes import ROUTE_WINDOW
from cabgrid.plans import jobs
from cabgrid.streaming import routes as sroutes


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cabgrid")
    sub = p.add_subparsers(dest="job", required=True)
    lengths = {"frequent-routes": ROUTE_WINDOW, "profitable-areas": AREA_WINDOW, "daytime-profile": ROUTE_WINDOW}
    for name, length in lengths.items():
        s = sub.add_parser(name)
        s.add_argument("trips")
        s.add_argument("out")
        s.add_argument("--k", type=int, default=10)
        s.add_argument("--length", default=length)
        s.add_argument("--slide", help="windows every so often; default: one after another")
        s.add_argument("--semantics", choices=("observed", "intended"), default="observed")
        s.add_argument("--input-format", choices=("csv", "parquet"), default="csv")
    s = sub.add_parser("prepare")
    s.add_argument("trip_dir")
    s.add_argument("fare_dir")
    s.add_argument("out")
    s.add_argument("--rows-per-file", type=int)
    s.add_argument("--output-format", choices=("csv", "parquet"), default="csv")
    s = sub.add_parser("stream-routes")
    s.add_argument("in_dir")
    s.add_argument("out")
    s.add_argument("checkpoint")
    s.add_argument("--k", type=int, default=10)
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--max-bytes-per-trigger")
    s.add_argument("--interval", help="processing-time trigger; default: all available files, then stop")
    s.add_argument("--watermark", default="30 minutes")
    s.add_argument("--no-watermark", dest="watermark", action="store_const", const=None)
    s.add_argument("--length", default=ROUTE_WINDOW)
    s = sub.add_parser("stream-open")
    s.add_argument("checkpoint")
    s.add_argument("out")
    s.add_argument("--k", type=int, default=10)
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"cabgrid-{a.job}").getOrCreate()
    if a.job == "frequent-routes":
        out = jobs.frequent_routes_job(spark, a.trips, a.out, a.k, a.length, a.semantics, a.input_format, a.slide)
    elif a.job == "profitable-areas":
        out = jobs.profitable_areas_job(spark, a.trips, a.out, a.k, a.length, a.semantics, a.input_format, a.slide)
    elif a.job == "daytime-profile":
        out = jobs.daytime_profile_job(spark, a.trips, a.out, a.k, a.length, a.semantics, a.input_format, a.slide)
    elif a.job == "prepare":
        out = jobs.prepare_job(spark, a.trip_dir, a.fare_dir, a.out, a.rows_per_file, a.output_format)
    elif a.job == "stream-open":
        sroutes.write_open_windows(spark, a.checkpoint, a.out, a.k)
        out = a.out
    else:
        trigger = {"processingTime": a.interval} if a.interval else None
        q = jobs.stream_routes_job(
            spark,
            a.in_dir,
            a.out,
            a.checkpoint,
            a.k,
            a.watermark,
            a.max_files_per_trigger,
            trigger,
            a.length,
            a.max_bytes_per_trigger,
        )
        q.awaitTermination()
        out = {"routes": a.out, "late_groups_dropped": sroutes.dropped_rows(q)}
    print(json.dumps({"job": a.job, "outputs": out}))


if __name__ == "__main__":
    main()
