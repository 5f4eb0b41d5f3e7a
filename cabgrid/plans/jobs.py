"""Batch and stream jobs: input files in, result files out (the original's job lifecycle).

Each job writes two outputs from one intermediate (route counts, or cell
profitability). The intermediate is ``checkpoint()``-ed into the session's
checkpoint folder first: both outputs read it instead of recomputing the scan
and aggregation, and its lineage is cut, so a lost executor does not force
a rescan of the input.

Outputs are sorted globally and written by many tasks: concatenating the
part files in name order gives the single sorted file of the original
(``cat out/*.csv``), without funnelling the result through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cabgrid.operators import areas, profiles, routes
from cabgrid.plans.prepare import prepare_trips
from cabgrid.session import checkpoint_root
from cabgrid.sources.files import read_trips, write_csv, write_trips_parquet
from cabgrid.streaming import routes as sroutes
from cabgrid.streaming.versions import update_writer


# Window times are UTC wall-clock values; written like the original outputs
# (``2013-01-01T00:30:00.000Z``) and read back with the same pattern.
OUTPUT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_OUT = {"timestampNTZFormat": OUTPUT_TS_FORMAT}


def _reliable(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)  # makes sure a checkpoint folder is set
    return df.checkpoint(eager=True)


def frequent_routes_job(
    spark: SparkSession,
    trips_path: str,
    out_dir: str,
    k: int = 10,
    length: str = routes.ROUTE_WINDOW,
    semantics: str = "observed",
    input_format: str = "csv",
    slide: str | None = None,
) -> dict[str, str]:
    """Q1 + Q1b: ``<out>/rankings`` (route, count, rank, window_end) and
    ``<out>/window_counts`` (route, count, trips_per_window, window_end)."""
    trips = read_trips(spark, trips_path, input_format)
    counts = _reliable(routes.route_counts(trips, length, slide, semantics))
    outputs = {"rankings": f"{out_dir}/rankings", "window_counts": f"{out_dir}/window_counts"}
    write_csv(routes.topk_routes(counts, k), outputs["rankings"], order_by=["window_end", "rank"], **_OUT)
    write_csv(routes.window_trip_totals(counts, semantics), outputs["window_counts"], order_by=["window_end"], **_OUT)
    return outputs


def profitable_areas_job(
    spark: SparkSession,
    trips_path: str,
    out_dir: str,
    k: int = 10,
    length: str = areas.AREA_WINDOW,
    semantics: str = "observed",
    input_format: str = "csv",
    slide: str | None = None,
) -> dict[str, str]:
    """Q2 + Q2b: ``<out>/profitability`` (window, cell, profitability, rank) and
    ``<out>/profitability_per_window`` (window, avg_profitability)."""
    trips = read_trips(spark, trips_path, input_format)
    max_secs = areas.SHORT_TRIP_SECS if semantics == "observed" else None
    prof = _reliable(areas.profitability(trips, length, max_secs, semantics=semantics, slide=slide))
    outputs = {
        "profitability": f"{out_dir}/profitability",
        "profitability_per_window": f"{out_dir}/profitability_per_window",
    }
    write_csv(areas.topk_cells(prof, k), outputs["profitability"], order_by=["window", "rank"], **_OUT)
    write_csv(areas.profitability_per_window(prof), outputs["profitability_per_window"], order_by=["window"], **_OUT)
    return outputs


def daytime_profile_job(
    spark: SparkSession,
    trips_path: str,
    out_dir: str,
    k: int = 10,
    length: str = routes.ROUTE_WINDOW,
    semantics: str = "observed",
    input_format: str = "csv",
    slide: str | None = None,
) -> str:
    """Q3: ``endtime, route, avg_count, local_rank`` per time of day, as sorted CSV."""
    counts = routes.route_counts(read_trips(spark, trips_path, input_format), length, slide, semantics)
    profile = profiles.route_daytime_profile(routes.topk_routes(counts, k), k)
    write_csv(profile, out_dir, order_by=["endtime", "local_rank"])
    return out_dir


def prepare_job(
    spark: SparkSession,
    trip_path: str,
    fare_path: str,
    out_dir: str,
    rows_per_file: int | None = None,
    output_format: str = "csv",
) -> str:
    """Q4: trip + fare files -> one trip table.

    ``csv``: headerless CSV sorted by drop-off time, like the original.
    ``parquet``: the Parquet store partitioned by drop-off date, for scale.
    """
    trips = prepare_trips(spark, trip_path, fare_path, rows_per_file)
    if output_format == "parquet":
        write_trips_parquet(trips, out_dir)
    else:
        # the columns after the drop-off time spread rows without one
        write_csv(trips, out_dir, order_by=["dropoff_datetime", "pickup_datetime", "medallion", "hack_license"])
    return out_dir


def stream_routes_job(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    k: int = 10,
    watermark: str | None = "30 minutes",
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
    length: str = routes.ROUTE_WINDOW,
    max_bytes_per_trigger: int | str | None = None,
) -> StreamingQuery:
    """Q5: top ``k`` routes of every closed window of a trip file stream, as Parquet.

    Without a watermark no row is late: every batch rewrites the counts and
    the ranking of the days it changed (``<out>/counts``, ``<out>/ranking``,
    see ``streaming/versions.py``), and the state grows with the stream.
    """
    stream = sroutes.read_trip_stream(
        spark, in_dir, max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger
    )
    counts = sroutes.stream_route_counts(stream, length, watermark=watermark)
    if watermark is None:
        return sroutes.start(counts, update_writer(out_dir, k), "update", checkpoint, trigger=trigger)
    return sroutes.start(counts, sroutes.topk_batch_writer(out_dir, k), "append", checkpoint, trigger=trigger)
