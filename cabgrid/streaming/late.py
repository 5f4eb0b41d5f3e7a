"""Route counts that lose no late row: what the watermark drops goes to a side table.

``counts_and_arrivals`` is one stream of two kinds of rows: the counts of the
windows that the watermark closes, and the trips of each micro-batch as they
arrive, in no window state. ``arrivals_writer`` adds the trips of a batch up
by (window, route) and writes both kinds to the batch's folder. Which of the
arrivals came too late follows from the batches alone: a trip of batch n is
late if its window had ended by the watermark that batch n - 1 ran under, the
latest event of batches up to n - 2 less the delay. ``late_counts`` lists
those, and ``merged_counts`` adds them to the closed windows.

The input is parsed twice, once for each kind. Arrivals are counts per batch,
window and route, so the side table grows with these, not with the trips.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.functions.grid import route_of_axes
from cabgrid.functions.timewin import micros, utc_wallclock
from cabgrid.operators.cells import AXES, in_grid_trips
from cabgrid.operators.routes import ROUTE_WINDOW

CLOSED, ARRIVED = 0, 1
_ROWS = T.StructType(
    [
        T.StructField("window_end", T.TimestampType()),
        T.StructField("route", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("latest", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("kind", T.IntegerType()),
    ]
)


def counts_and_arrivals(
    stream: DataFrame, watermark: str, length: str = ROUTE_WINDOW, semantics: str = "observed"
) -> DataFrame:
    """``kind, window_end``, the route's axes, ``count`` and, of arrivals, the event time ``at``."""
    t = in_grid_trips(stream, semantics).withWatermark("dropoff_datetime", watermark)
    window = F.window("dropoff_datetime", length)
    closed = (
        t.groupBy(window.alias("window"), *AXES)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.lit(CLOSED).alias("kind"),
            F.col("window.end").alias("window_end"),
            *AXES,
            "count",
            F.lit(None).cast("timestamp").alias("at"),
        )
    )
    arrived = t.select(
        F.lit(ARRIVED).alias("kind"),
        window.end.alias("window_end"),
        *AXES,
        F.lit(1).cast("long").alias("count"),
        F.col("dropoff_datetime").alias("at"),
    )
    return closed.unionByName(arrived)


def arrivals_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Writes closed windows and arrivals of a batch to ``<path>/batch_id=<n>/kind=<kind>``, each added up."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("kind", "window_end", *AXES).agg(F.sum("count").alias("count"), F.max("at").alias("latest"))
        rows = sums.select("window_end", route_of_axes(*AXES).alias("route"), "count", "latest", "kind")
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch_id={batch_id}")

    return write


def _rows(spark: SparkSession, path: str, kind: int) -> DataFrame:
    return spark.read.schema(_ROWS).parquet(path).where(F.col("kind") == kind)


def closed_counts(spark: SparkSession, path: str) -> DataFrame:
    """``window_end, route, count`` as the watermark closed the windows."""
    return _rows(spark, path, CLOSED).select(utc_wallclock("window_end").alias("window_end"), "route", "count")


def late_counts(spark: SparkSession, path: str, watermark: str) -> DataFrame:
    """``window_end, route, count`` of the trips that came behind the watermark; ``watermark`` is the stream's."""
    arrived = _rows(spark, path, ARRIVED)
    # a row per batch
    earlier = Window.partitionBy(F.lit(0)).orderBy("batch_id").rangeBetween(Window.unboundedPreceding, -2)
    marks = arrived.groupBy("batch_id").agg(F.max("latest").alias("latest"))
    closed_until = F.unix_millis(F.max("latest").over(earlier)) - micros(watermark) // 1000
    marks = marks.select("batch_id", closed_until.alias("closed_until"))
    late = arrived.join(marks, "batch_id").where(F.unix_millis("window_end") <= F.col("closed_until"))
    late = late.groupBy("window_end", "route").agg(F.sum("count").alias("count"))
    return late.select(utc_wallclock("window_end").alias("window_end"), "route", "count")


def merged_counts(spark: SparkSession, path: str, watermark: str) -> DataFrame:
    """Closed windows with their late trips added: ``window_end, route, count``."""
    both = closed_counts(spark, path).unionByName(late_counts(spark, path, watermark))
    return both.groupBy("window_end", "route").agg(F.sum("count").alias("count"))
