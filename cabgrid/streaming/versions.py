"""A table that update-mode batches keep current: each batch rewrites the days it changed.

Complete mode hands the whole result to every batch. Update mode hands on the
(window, route) counts that changed; ``update_writer`` merges them with the
latest version of their days and writes those days as a new version
(``batch_id=<n>/day=<date>/``). Files of other days and of earlier versions
stay untouched, so a reader is never without a table, and a replayed batch
overwrites its own folder only. For each day the version with the largest
batch number holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.functions.timewin import utc_wallclock
from cabgrid.operators.routes import topk_routes

COUNTS = T.StructType(
    [
        T.StructField("window_end", T.TimestampType()),
        T.StructField("route", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)
RANKING = T.StructType([COUNTS["route"], COUNTS["count"], T.StructField("rank", T.IntegerType()), COUNTS["window_end"]])
_VERSION = [T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType())]


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, day`` of every version of every day, from the listing of the files alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    part = lambda name: F.regexp_extract("path", rf"{name}=([^/]+)/", 1)
    return files.select(part("batch_id").cast("long").alias("batch_id"), part("day").cast("date").alias("day")).distinct()


def read_latest(spark: SparkSession, path: str, schema: T.StructType = COUNTS, before: int | None = None) -> DataFrame:
    """The latest version of each day (with ``before``, of those written by earlier batches)."""
    versions = _versions(spark, path)
    if before is not None:
        versions = versions.where(F.col("batch_id") < before)
    latest = versions.groupBy("day").agg(F.max("batch_id").alias("batch_id"))
    rows = spark.read.schema(T.StructType([*schema.fields, *_VERSION])).parquet(path)
    return rows.join(latest, ["day", "batch_id"], "left_semi").select(*schema.names)


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, day`` of the versions that a later one replaced: their folders may be deleted."""
    versions = _versions(spark, path)
    latest = versions.groupBy("day").agg(F.max("batch_id").alias("latest"))
    return versions.join(latest, "day").where("batch_id < latest").select("batch_id", "day")


def update_writer(path: str, k: int | None = None) -> Callable[[DataFrame, int], None]:
    """Keeps ``<path>/counts`` current and, with ``k``, ``<path>/ranking``: the top ``k`` routes of each window.

    For update-mode batches of ``window_end, route, count``. A count never
    falls, so the larger of two is the later one, and a replayed batch gives
    the same table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date(utc_wallclock("window_end"))
        # the stateful plan runs once: all further steps read what it changed
        changed_path = f"{path}/changed/batch_id={batch_id}"
        batch.select(*COUNTS.names).write.mode("overwrite").parquet(changed_path)
        changed = spark.read.schema(COUNTS).parquet(changed_path).withColumn("day", day)
        merged = changed
        if batch_id > 0:
            held = read_latest(spark, f"{path}/counts", before=batch_id).withColumn("day", day)
            merged = changed.unionByName(held.join(changed.select("day").distinct(), "day", "left_semi"))
        # dealt out in order of time, a batch has a file for each day and one more for each task, not days times tasks
        key = ["day", "window_end", "route"]
        merged = merged.repartitionByRange(*key).groupBy(*key).agg(F.max("count").alias("count"))
        table = f"{path}/counts/batch_id={batch_id}"
        merged.write.mode("overwrite").partitionBy("day").parquet(table)
        if k is not None:
            days = spark.read.schema(T.StructType([*COUNTS.fields, _VERSION[1]])).parquet(table).drop("day")
            ranked = topk_routes(days.repartitionByRange("window_end"), k).withColumn("day", day)
            ranked.write.mode("overwrite").partitionBy("day").parquet(f"{path}/ranking/batch_id={batch_id}")

    return write
