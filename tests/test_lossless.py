"""No row is lost or doubled: null times, several files per pairing key, other splits after the call."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cabgrid.operators.areas import area_stats, dropoff_counts
from cabgrid.plans.prepare import prepare_trips, read_column_files
from cabgrid.session import scratch_path
from cabgrid.sources.files import read_csv, with_file_position
from cabgrid.sources.schema import TRIP_SCHEMA


def test_trips_without_pickup_time_count_as_dropoffs(trips_small):
    gaps = trips_small.withColumn(
        "pickup_datetime", F.when(F.xxhash64("pickup_datetime", "medallion") % 10 != 0, F.col("pickup_datetime"))
    )
    assert gaps.where("pickup_datetime IS NULL").count() > 0
    total = area_stats(gaps).agg(F.sum("dropoff_count")).first()[0]
    assert total == area_stats(trips_small).agg(F.sum("dropoff_count")).first()[0]


def _pairs(spark, root, parts):
    n = 0
    for year in (2013, 2014):
        rows = spark.range(n, n + 600, 1, parts).select(F.col("id").cast("string").alias("medallion"))
        n += 600
        rest = [F.lit("").alias(f" {f.name}") for f in TRIP_SCHEMA if f.name not in ("medallion", "fare_amount")]
        rows.select("medallion", *rest).write.option("header", True).csv(f"{root}/trip/{year}/trip_data_1.csv")
        rows.select(F.concat(F.lit("1"), "medallion").alias(" fare_amount")).write.option("header", True).csv(
            f"{root}/fare/{year}/trip_fare_1.csv"
        )


@pytest.mark.parametrize("parts", [1, 3])
def test_files_that_share_a_number_pair_one_by_one(spark, parts):
    root = scratch_path(spark, "pairs")
    _pairs(spark, root, parts)
    merged = prepare_trips(spark, f"{root}/trip/*/*", f"{root}/fare/*/*")
    rows = merged.select("medallion", "fare_amount").collect()
    assert len(rows) == 1200 and all(float(f"1{r[0]}") == r[1] for r in rows)


def test_columns_with_several_files_per_chunk(spark):
    root = scratch_path(spark, "columns")
    ids = spark.range(0, 900, 1, 3).withColumn("chunk", (F.col("id") / 450).cast("int"))
    for c in ("a", "b"):
        ids.select("chunk", F.concat(F.lit(c), F.col("id").cast("string")).alias("value")).write.partitionBy("chunk").text(f"{root}/{c}")
    rows = read_column_files(spark, root, ["a", "b"]).collect()
    assert len(rows) == 900 and all(r["a"][1:] == r["b"][1:] for r in rows)


def test_positions_survive_other_splits(spark):
    path = scratch_path(spark, "splits")
    spark.range(0, 60000, 1, 1).select(F.col("id").cast("string"), F.lit("x" * 100)).write.csv(path)
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "4")
        placed = with_file_position(read_csv(spark, path, schema=None))
        spark.conf.set("spark.sql.files.minPartitionNum", "3")
        assert placed.where(F.col("_c0").cast("long") == F.col("row_pos")).count() == 60000
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if old is None else spark.conf.set("spark.sql.files.minPartitionNum", old)


def test_dropoffs_alone_agree(trips_small):
    joined = area_stats(trips_small, max_secs=None).agg(F.sum("dropoff_count")).first()[0]
    assert joined == dropoff_counts(trips_small).agg(F.sum("dropoff_count")).first()[0]
