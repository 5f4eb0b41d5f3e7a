"""Q5: frequent routes on a file stream.

* Source: a folder of headerless trip CSV files read with the declared
  schema; ``maxFilesPerTrigger`` bounds the intake per micro-batch and
  ``cleanSource`` (``archive``/``delete``) keeps a rolling input folder.
* ``stream_route_counts`` is the windowed count per route. Without a
  watermark the state is unbounded and only ``complete`` mode applies (the
  original); with a watermark, ``append`` mode emits each window once, whole,
  when the watermark passes its end, and its state is dropped.
* Top-k needs ``row_number``, which streams refuse; ``topk_batch_writer``
  ranks each micro-batch of closed windows in ``foreachBatch``. Writes go to
  ``batch_id=<n>`` folders with overwrite, so a replayed batch is idempotent.
  That is one folder per micro-batch: with short triggers, compact old
  batches periodically (read them, rewrite by window date) or trigger less
  often; each window appears in exactly one batch, so compaction is a plain
  union.
* In append mode the last windows stay open until later rows arrive. At the
  end of a finite input ``open_windows`` reads them from the state store of
  the checkpoint; the input folder stays as it is.
* Late rows are dropped by the watermark. ``streaming/late.py`` keeps them.
* Without a watermark, ``update`` mode hands on the changed counts only;
  ``streaming/versions.py`` keeps them as a table of which a batch rewrites
  the days it touched.
* Sinks and checkpoints live under the shared checkpoint folder, so a
  restarted query resumes after a lost driver or executor.

Watermarks refuse ``TIMESTAMP_NTZ``: streams read ``TIMESTAMP`` and outputs
convert window ends back to UTC wall-clock ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cabgrid.functions.grid import route_of_axes
from cabgrid.functions.timewin import utc_wallclock, wallclock_instant
from cabgrid.operators.cells import AXES, in_grid_trips
from cabgrid.operators.routes import ROUTE_WINDOW, topk_routes
from cabgrid.sources.schema import STREAM_TRIP_SCHEMA

AVAILABLE_NOW = {"availableNow": True}


def read_trip_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STREAM_TRIP_SCHEMA,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    max_bytes_per_trigger: int | str | None = None,
    **options,
) -> DataFrame:
    """A folder of headerless trip CSV files as a stream.

    A micro-batch takes files up to ``max_files_per_trigger`` of them, or up
    to ``max_bytes_per_trigger`` (``"512m"``): the limit to use when files
    differ in size. A file larger than the limit is a batch of its own.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("limit a batch by files or by bytes, not by both")
    reader = spark.readStream.schema(schema).option("header", False).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.csv(path)


def stream_route_counts(
    stream: DataFrame,
    length: str = ROUTE_WINDOW,
    watermark: str | None = None,
    semantics: str = "observed",
) -> DataFrame:
    """``window_end, route, count`` per (drop-off window, route) on a stream."""
    t = in_grid_trips(stream, semantics)
    if watermark:
        t = t.withWatermark("dropoff_datetime", watermark)
    return (
        t.groupBy(F.window("dropoff_datetime", length).alias("window"), *AXES)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.end").alias("window_end"), route_of_axes(*AXES).alias("route"), "count")
    )


def stream_trip_totals(stream: DataFrame, length: str = ROUTE_WINDOW, semantics: str = "observed") -> DataFrame:
    """``window_end, trips``: trips per drop-off window on a stream, one row per window."""
    t = in_grid_trips(stream, semantics)
    totals = t.groupBy(F.window("dropoff_datetime", length).alias("window")).agg(F.count(F.lit(1)).alias("trips"))
    return totals.select(F.col("window.end").alias("window_end"), "trips")


def start(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    output_mode: str = "append",
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    **options,
) -> StreamingQuery:
    """Starts a query on a format sink (``parquet``, ``console``, ...) or a batch function."""
    w = df.writeStream.outputMode(output_mode).options(**options)
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or AVAILABLE_NOW)).start()


def overwrite_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Complete-mode batches replace the table: the last batch holds the full result."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def topk_batch_writer(path: str, k: int = 10) -> Callable[[DataFrame, int], None]:
    """Top ``k`` routes of the windows closed in each append-mode batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        topk_routes(batch, k).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def open_windows(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """``window_end, route, count`` of the windows that a stopped query of route counts has not emitted yet.

    Read from the state store at the query's last committed batch: after the
    end of a finite input, the emitted windows and these are all windows. The
    checkpoint does not change, so the query may be started again later; it
    then emits these windows itself once they are closed, and what was read
    here is replaced. Without a watermark no window is ever closed, and these
    are the counts so far. Window ends are UTC wall clock.
    """
    state = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    return state.select(
        utc_wallclock("key.window.end").alias("window_end"),
        route_of_axes(*[f"key.{a}" for a in AXES]).alias("route"),
        F.col("value.count").alias("count"),
    )


def write_open_windows(spark: SparkSession, checkpoint: str, path: str, k: int | None = None) -> None:
    """Replaces the table at ``path`` by the open windows, or by their top ``k`` routes.

    Window ends are instants, as in the sinks of the query itself.
    """
    counts = open_windows(spark, checkpoint).withColumn("window_end", wallclock_instant("window_end"))
    out = counts if k is None else topk_routes(counts, k)
    out.write.mode("overwrite").parquet(path)


def dropped_rows(query: StreamingQuery) -> int:
    """Late (window, route) groups that the watermark dropped, in the batches the query still reports."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", []))


def read_window_output(spark: SparkSession, path: str, time_cols=("window_end",)) -> DataFrame:
    """A sink's table with window ends as UTC wall-clock ``TIMESTAMP_NTZ``."""
    df = spark.read.parquet(path)
    if "batch_id" in df.columns:
        df = df.drop("batch_id")
    return df.withColumns({c: utc_wallclock(c) for c in time_cols})


def ordered_counts(counts: DataFrame) -> DataFrame:
    """Whole result table sorted by window, then most frequent route.

    Streams accept a sort only after an aggregation in ``complete`` mode.
    """
    return counts.orderBy("window_end", F.desc("count"), "route")
