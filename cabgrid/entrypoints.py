"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each one derives trips from the whole ``events`` table of ``sf_dir`` and runs
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid.functions.timewin import utc_wallclock
from cabgrid.operators import areas, cells, frames, profiles, routes
from cabgrid.plans import queries as Q
from cabgrid.plans.prepare import prepare_trips, prepare_trips_by_keys, read_column_files
from cabgrid.session import few_listing_tasks, scratch_path
from cabgrid.sources import fixture
from cabgrid.sources.files import (
    join_parts,
    read_csv,
    read_per_window,
    read_trips,
    union_all,
    write_csv,
    write_per_window,
    write_trips_parquet,
)
from cabgrid.sources.fixture import load_trips
from cabgrid.sources.schema import COLUMN_STREAM_COLUMNS, RANKING_SCHEMA, TRIP_COLUMNS
from cabgrid.streaming import columns as scol
from cabgrid.streaming import late as slate
from cabgrid.streaming import routes as sroutes
from cabgrid.streaming import versions as sversions

K = 10
# First rows read of every trip and fare file (the original's ``nrows``); the
# files hold fixture.ROWS_PER_FILE rows each.
FILE_ROW_LIMIT = 2000
# Files that a micro-batch of the counted stream takes at most.
FILES_PER_TRIGGER = 1000
WATERMARK = "30 minutes"
# Digits kept on means of doubles, here and in the SQL: summation order must not decide ranks.
MEAN_DIGITS = 9


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return load_trips(spark, sf)


def _counts(spark, sf):
    return routes.route_counts(_trips(spark, sf))


# --- grid, projections, filters ------------------------------------------


def cell_of_point(spark, sf):
    t = cells.with_cells(_trips(spark, sf))
    return t.select("trip_id", "cell_start", "cell_end")


def route_of_trip(spark, sf):
    return cells.with_cells(_trips(spark, sf)).select("trip_id", "route")


def cell_axes(spark, sf):
    t = cells.with_axis_codes(_trips(spark, sf), scol.AXIS_CODES)
    return t.select("trip_id", *scol.AXIS_CODES)


def outlier_filter(spark, sf):
    return cells.outlier_filter(_trips(spark, sf))


def short_trips(spark, sf):
    return areas.short_trips(_trips(spark, sf))


def trip_revenue(spark, sf):
    return areas.trip_revenue(_trips(spark, sf)).select("trip_id", "total_profit")


def window_bounds(spark, sf):
    return frames.flatten_structs(routes.route_counts_by_window(_trips(spark, sf)))


def frame_shape(spark, sf):
    return frames.frame_shape(_trips(spark, sf))


def sql_view_filter(spark, sf):
    view = f"route_counts_{uuid.uuid4().hex[:8]}"
    _counts(spark, sf).createOrReplaceTempView(view)
    try:
        # Analysis inlines the view's plan, so the view can go right away.
        return spark.sql(f"SELECT window_end, route, count FROM {view} WHERE count = 5")
    finally:
        spark.catalog.dropTempView(view)


# --- frequent routes -------------------------------------------------------


def route_counts(spark, sf):
    return _counts(spark, sf)


def topk_routes(spark, sf):
    return Q.frequent_routes(_trips(spark, sf), K)


def window_trip_totals(spark, sf):
    return Q.window_trip_totals(_trips(spark, sf))


def window_trip_totals_intended(spark, sf):
    return Q.window_trip_totals(_trips(spark, sf), semantics="intended")


def running_route_trips(spark, sf):
    return routes.running_route_trips(_counts(spark, sf))


def rank_routes_with_ties(spark, sf):
    return routes.rank_routes_with_ties(_counts(spark, sf), K)


def frequent_routes_overall(spark, sf):
    return routes.frequent_routes_overall(_counts(spark, sf))


def distinct_windows(spark, sf):
    return routes.distinct_windows(_trips(spark, sf))


def topk_routes_intended(spark, sf):
    return Q.frequent_routes(_trips(spark, sf), K, semantics="intended")


def topk_routes_sliding(spark, sf):
    return Q.frequent_routes(_trips(spark, sf), K, slide="15 minutes")


# --- profitable areas ------------------------------------------------------


def dropoff_counts(spark, sf):
    return areas.dropoff_counts(_trips(spark, sf))


def pickup_counts(spark, sf):
    return areas.pickup_counts(_trips(spark, sf))


def empty_cabs(spark, sf):
    return areas.empty_cabs(_trips(spark, sf))


def area_profit(spark, sf):
    return areas.area_profit(_trips(spark, sf))


def profitability(spark, sf):
    return areas.profitability(_trips(spark, sf))


def topk_cells(spark, sf):
    return Q.profitable_cells(_trips(spark, sf), K)


def topk_cells_k3(spark, sf):
    return Q.profitable_cells(_trips(spark, sf), 3)


def profitability_per_window(spark, sf):
    out = Q.profitability_per_window(_trips(spark, sf))
    return out.withColumn("avg_profitability", F.round("avg_profitability", MEAN_DIGITS))


def empty_taxis_intended(spark, sf):
    return areas.empty_taxis(_trips(spark, sf))


def profitable_cells_intended(spark, sf):
    return Q.profitable_cells(_trips(spark, sf), K, max_secs=None, semantics="intended")


def profitable_cells_sliding(spark, sf):
    return Q.profitable_cells(_trips(spark, sf), K, max_secs=None, semantics="intended", slide="5 minutes")


def empty_cabs_sliding(spark, sf):
    return areas.empty_cabs(_trips(spark, sf), slide="5 minutes")


def profitability_sliding(spark, sf):
    """The observed rule over 15 minutes, every 5 minutes."""
    return areas.profitability(_trips(spark, sf), slide="5 minutes")


# --- time-of-day profiles --------------------------------------------------


def route_daytime_profile(spark, sf):
    return Q.daytime_profile(_trips(spark, sf), K)


def busiest_times(spark, sf):
    return profiles.busiest_times(Q.window_trip_totals(_trips(spark, sf)))


def cell_daytime_profile(spark, sf):
    return profiles.cell_daytime_profile(Q.profitable_cells(_trips(spark, sf), K), K, MEAN_DIGITS)


def profitable_times(spark, sf):
    return profiles.profitable_times(Q.profitability_per_window(_trips(spark, sf)), MEAN_DIGITS)


# --- files: scans, sinks, preparation ------------------------------------


def scan_trips_csv(spark, sf):
    path = scratch_path(spark, "trips-csv")
    write_csv(_trips(spark, sf).select(*TRIP_COLUMNS), path)
    return read_csv(spark, f"{path}/*.csv")


def scan_trips_parquet(spark, sf):
    path = scratch_path(spark, "trips-parquet")
    write_trips_parquet(_trips(spark, sf).select(*TRIP_COLUMNS), path)
    return read_trips(spark, path, "parquet").select(*TRIP_COLUMNS, F.col("dropoff_date").cast("string"))


def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "ranked-csv")
    write_csv(Q.frequent_routes(_trips(spark, sf), K), path, order_by=["window_end", "rank"])
    return read_csv(spark, path, schema=RANKING_SCHEMA)


def sink_single_csv(spark, sf):
    """The ranking as one file: many tasks write it sorted, then the file system joins the parts."""
    path = scratch_path(spark, "ranked-parts")
    write_csv(Q.frequent_routes(_trips(spark, sf), K), path, order_by=["window_end", "rank"])
    return read_csv(spark, join_parts(spark, path, f"{path}.csv"), schema=RANKING_SCHEMA)


def sink_per_window(spark, sf):
    path = scratch_path(spark, "per-window")
    write_per_window(Q.frequent_routes(_trips(spark, sf), K), path)
    return read_per_window(spark, path, RANKING_SCHEMA)


def _trip_fare_files(spark, sf):
    trip_dir, fare_dir = scratch_path(spark, "trip-files"), scratch_path(spark, "fare-files")
    fixture.write_trip_fare_files(_trips(spark, sf), trip_dir, fare_dir)
    return trip_dir, fare_dir


def merge_fare_trip(spark, sf):
    trip_dir, fare_dir = _trip_fare_files(spark, sf)
    return prepare_trips(spark, trip_dir, fare_dir, pair_on="chunk")


def merge_fare_trip_keys(spark, sf):
    """Trips and fares whose files and rows are in no common order."""
    trip_dir, fare_dir = scratch_path(spark, "trip-files"), scratch_path(spark, "fare-files")
    fixture.write_unordered_trip_fare_files(_trips(spark, sf), trip_dir, fare_dir)
    return prepare_trips_by_keys(spark, trip_dir, fare_dir)


def scan_limit_per_file(spark, sf):
    trip_dir, fare_dir = _trip_fare_files(spark, sf)
    return prepare_trips(spark, trip_dir, fare_dir, rows_per_file=FILE_ROW_LIMIT, pair_on="chunk")


def positional_zip(spark, sf):
    root = scratch_path(spark, "column-files")
    fixture.write_column_files(_trips(spark, sf), root, COLUMN_STREAM_COLUMNS)
    rows = read_column_files(spark, root, COLUMN_STREAM_COLUMNS)
    return _zipped(rows.withColumnRenamed("_pair", "file_key"))


def _zipped(rows):
    """Typed cell axes of rows of text columns."""
    typed = rows.select(
        "file_key",
        F.col("row_pos").cast("long").alias("row_pos"),
        F.col("dropoff_datetime").try_cast("timestamp_ntz").alias("dropoff_datetime"),
        *[F.col(c).try_cast("double").alias(c) for c in COLUMN_STREAM_COLUMNS[1:]],
    )
    return cells.with_axis_codes(typed, scol.AXIS_CODES).select(
        "file_key", "row_pos", "dropoff_datetime", *scol.AXIS_CODES
    )


def union_months(spark, sf):
    t = _trips(spark, sf).select(*TRIP_COLUMNS)
    am = F.coalesce(F.hour("dropoff_datetime") < 12, F.lit(False))  # null times go to the second file
    paths = [scratch_path(spark, "trips-am"), scratch_path(spark, "trips-pm")]
    write_csv(t.where(am), paths[0])
    write_csv(t.where(~am), paths[1])
    return union_all([read_csv(spark, p) for p in paths])


def sorted_trips(spark, sf):
    return _trips(spark, sf).orderBy("dropoff_datetime", "trip_id")


# --- streams ---------------------------------------------------------------


def _run(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _stream_dirs(spark, sf, columns=None):
    src = scratch_path(spark, "stream-in")
    fixture.write_stream_files(_trips(spark, sf), src, columns)
    return src, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")


def stream_route_counts_complete(spark, sf):
    src, out, ck = _stream_dirs(spark, sf)
    counts = sroutes.stream_route_counts(sroutes.read_trip_stream(spark, src))
    _run(sroutes.start(counts, sroutes.overwrite_writer(out), "complete", ck))
    return sroutes.read_window_output(spark, out)


def stream_route_counts_append(spark, sf):
    """Windows as the watermark closes them and, as the input ends, the open ones from the state."""
    src, out, ck = _stream_dirs(spark, sf)
    counts = sroutes.stream_route_counts(sroutes.read_trip_stream(spark, src), watermark=WATERMARK)
    _run(sroutes.start(counts, "parquet", "append", ck, path=out))
    return sroutes.read_window_output(spark, out).unionByName(sroutes.open_windows(spark, ck))


def stream_topk_routes(spark, sf):
    src, out, ck = _stream_dirs(spark, sf)
    counts = sroutes.stream_route_counts(sroutes.read_trip_stream(spark, src), watermark=WATERMARK)
    _run(sroutes.start(counts, sroutes.topk_batch_writer(out, K), "append", ck))
    last = scratch_path(spark, "stream-open")
    sroutes.write_open_windows(spark, ck, last, K)
    return sroutes.read_window_output(spark, out).unionByName(sroutes.read_window_output(spark, last))


def _update_stream(spark, sf, k=None):
    """The folder of an update-mode stream whose input comes in two parts, the later trips first."""
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    for src in _two_arrivals(spark, sf):
        counts = sroutes.stream_route_counts(sroutes.read_trip_stream(spark, src))
        _run(sroutes.start(counts, sversions.update_writer(out, k), "update", ck))
    return out


def _two_arrivals(spark, sf):
    """A stream's folder, yielded when the later half of the trips has come and again with the earlier half."""
    src = scratch_path(spark, "stream-in")
    trips = _trips(spark, sf)
    half = trips.agg(F.max("trip_id")).first()[0] or 0
    for part in (F.col("trip_id") > half // 2, F.col("trip_id") <= half // 2):
        fixture.write_stream_files(trips.where(part), src, mode="append")
        yield src


def stream_route_counts_update(spark, sf):
    """Each batch rewrites the days it changed, as a new version."""
    path = _update_stream(spark, sf)
    return sversions.read_latest(spark, f"{path}/counts").withColumn("window_end", utc_wallclock("window_end"))


def stream_topk_routes_update(spark, sf):
    path = _update_stream(spark, sf, K)
    ranking = sversions.read_latest(spark, f"{path}/ranking", sversions.RANKING)
    return ranking.withColumn("window_end", utc_wallclock("window_end"))


def stream_late_rows(spark, sf):
    """Half of the trips come behind the watermark: closed windows, late rows and open windows are the whole."""
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    for src in _two_arrivals(spark, sf):
        both = slate.counts_and_arrivals(sroutes.read_trip_stream(spark, src), WATERMARK)
        _run(sroutes.start(both, slate.arrivals_writer(out), "append", ck))
    return slate.merged_counts(spark, out, WATERMARK).unionByName(sroutes.open_windows(spark, ck))


def stream_late_side_table(spark, sf):
    """What the side table holds: the counts that a watermark alone would have dropped."""
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    for src in _two_arrivals(spark, sf):
        both = slate.counts_and_arrivals(sroutes.read_trip_stream(spark, src), WATERMARK)
        _run(sroutes.start(both, slate.arrivals_writer(out), "append", ck))
    return slate.late_counts(spark, out, WATERMARK)


def stream_route_counts_bytes(spark, sf):
    """Intake by bytes under a processing-time trigger: an eighth of the input a batch, a megabyte at least."""
    src, out, ck = _stream_dirs(spark, sf)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src)
    limit = max(1 << 20, (files.agg(F.sum("length")).first()[0] or 0) // 8)
    stream = sroutes.read_trip_stream(spark, src, max_bytes_per_trigger=limit)
    counts = sroutes.stream_route_counts(stream, watermark=None)
    query = sroutes.start(counts, sversions.update_writer(out), "update", ck, trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sversions.read_latest(spark, f"{out}/counts").withColumn("window_end", utc_wallclock("window_end"))


def stream_clean_source(spark, sf):
    """Rolling input: files that a later batch has left behind move to an archive."""
    out, ck, archive = (scratch_path(spark, f"stream-{x}") for x in ("out", "ck", "archive"))
    for src in _two_arrivals(spark, sf):
        stream = sroutes.read_trip_stream(spark, src, clean_source="archive", archive_dir=archive)
        _run(sroutes.start(sroutes.stream_route_counts(stream), sversions.update_writer(out), "update", ck))
    return sversions.read_latest(spark, f"{out}/counts").withColumn("window_end", utc_wallclock("window_end"))


def stream_sorted_counts(spark, sf):
    """The whole result table, sorted inside the stream (complete mode)."""
    src, out, ck = _stream_dirs(spark, sf)
    counts = sroutes.ordered_counts(sroutes.stream_route_counts(sroutes.read_trip_stream(spark, src)))
    _run(sroutes.start(counts, sroutes.overwrite_writer(out), "complete", ck))
    return sroutes.read_window_output(spark, out)


def stream_memory_totals(spark, sf):
    """Trips per window in the memory sink, asked for by the query's name: a row per window is all it holds."""
    src, _, ck = _stream_dirs(spark, sf)
    name = f"trip_totals_{uuid.uuid4().hex[:8]}"
    totals = sroutes.stream_trip_totals(sroutes.read_trip_stream(spark, src))
    _run(sroutes.start(totals, "memory", "complete", ck, query_name=name))
    try:
        return spark.sql(f"SELECT window_end, trips FROM {name}").withColumn("window_end", utc_wallclock("window_end"))
    finally:
        spark.catalog.dropTempView(name)


def stream_positional_join(spark, sf):
    """Five column streams joined by file and position."""
    root, out, ck = (scratch_path(spark, x) for x in ("column-files", "stream-out", "stream-ck"))
    fixture.write_column_files(_trips(spark, sf), root, COLUMN_STREAM_COLUMNS)
    with few_listing_tasks(spark):
        lines = {c: scol.read_column_lines(spark, f"{root}/{c}") for c in COLUMN_STREAM_COLUMNS}
        _run(sroutes.start(scol.join_column_streams(lines), "parquet", "append", ck, path=out))
    return _zipped(spark.read.parquet(out).withColumn("file_key", F.substring_index("file_key", "/", 1)))


def stream_cell_pairs(spark, sf):
    src, out, ck = _stream_dirs(spark, sf, COLUMN_STREAM_COLUMNS)
    pairs = scol.cell_pairs(scol.read_column_stream(spark, src))
    _run(sroutes.start(pairs, "parquet", "append", ck, path=out))
    return sroutes.read_window_output(spark, out, ("dropoff_datetime",))


def stream_batch_counts(spark, sf):
    """A file is a batch of the producer's; a micro-batch takes many of them and counts each."""
    src, out, ck = _stream_dirs(spark, sf, COLUMN_STREAM_COLUMNS)
    stream = scol.read_column_stream(spark, src, max_files_per_trigger=FILES_PER_TRIGGER, file_col="source_file")
    writer = scol.batch_counts_writer(out, rows_path=scratch_path(spark, "stream-rows"), by="source_file")
    _run(sroutes.start(stream, writer, "append", ck))
    return sroutes.read_window_output(spark, out, ("first_time", "last_time"))


QUERIES = {
    f.__name__: f
    for f in [
        cell_of_point,
        route_of_trip,
        cell_axes,
        outlier_filter,
        short_trips,
        trip_revenue,
        window_bounds,
        frame_shape,
        sql_view_filter,
        route_counts,
        topk_routes,
        window_trip_totals,
        window_trip_totals_intended,
        running_route_trips,
        rank_routes_with_ties,
        frequent_routes_overall,
        distinct_windows,
        topk_routes_intended,
        topk_routes_sliding,
        dropoff_counts,
        pickup_counts,
        empty_cabs,
        area_profit,
        profitability,
        topk_cells,
        topk_cells_k3,
        profitability_per_window,
        empty_taxis_intended,
        profitable_cells_intended,
        profitable_cells_sliding,
        empty_cabs_sliding,
        profitability_sliding,
        route_daytime_profile,
        busiest_times,
        cell_daytime_profile,
        profitable_times,
        scan_trips_csv,
        scan_trips_parquet,
        sink_csv_roundtrip,
        sink_single_csv,
        sink_per_window,
        merge_fare_trip,
        merge_fare_trip_keys,
        scan_limit_per_file,
        positional_zip,
        union_months,
        sorted_trips,
        stream_route_counts_complete,
        stream_route_counts_append,
        stream_route_counts_update,
        stream_route_counts_bytes,
        stream_late_rows,
        stream_late_side_table,
        stream_clean_source,
        stream_sorted_counts,
        stream_memory_totals,
        stream_topk_routes_update,
        stream_positional_join,
        stream_topk_routes,
        stream_cell_pairs,
        stream_batch_counts,
    ]
}
