"""Q4: trip and fare CSV files merged into one typed trip table.

The original lists two folders, pairs the n-th fare file with the n-th trip
file, reads the first ``rows_per_file`` rows of each, joins them by row
position, strips blanks from header names, keeps the 17 canonical columns
(trip values win for shared names) and concatenates all pairs.

Here both folders are read once each, in parallel; files pair on a key taken
from the path (a partition column such as ``chunk``, or the digits at the end
of the file name) instead of listing order, which is arbitrary on a cluster.
The positional join is a full outer join on (pair key, number of the file
among those of the key, row position).

``match_fares`` needs no order of files or rows: it joins trips and fares on
the columns that identify a ride on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabgrid.sources.files import (
    cast_to_schema,
    first_rows_per_file,
    read_csv,
    strip_blanks,
    union_all,
    with_file_position,
)
from cabgrid.sources.schema import TRIP_SCHEMA

# The columns that trip and fare files share.
RIDE_KEYS = ("medallion", "hack_license", "pickup_datetime")


def file_pair_key(pair_on: str | None) -> Column:
    """The pairing key of a file.

    With ``pair_on``, a partition column both folders share (``chunk=...``).
    Otherwise the last number in the file name, where a Spark-written
    ``part-*`` file stands for its folder: ``trip_data_7.csv`` and
    ``trip_fare_7.csv/part-00000-....csv`` both give ``7``.
    """
    if pair_on:
        return F.col(pair_on).cast("string")
    return F.regexp_extract(F.col("source_file"), r"(\d+)\D*?(?:/part-[^/]*)?$", 1)


def with_pair_key(df: DataFrame, pair_on: str | None) -> DataFrame:
    """Adds ``_pair`` and ``_nth``: files of one key are numbered in the order of their paths.

    So files with the same number in several folders pair one by one, as long
    as both sides have the same folders.
    """
    df = df.withColumn("_pair", file_pair_key(pair_on))
    nth = F.row_number().over(Window.partitionBy("_pair").orderBy("source_file"))
    files = df.select("_pair", "source_file").distinct().withColumn("_nth", nth)
    return df.join(files, ["_pair", "source_file"])


def read_positioned(spark: SparkSession, path: str, pair_on: str | None, rows_per_file: int | None) -> DataFrame:
    """A folder's rows with their positions; with ``rows_per_file``, the first rows of each file, the only ones read."""
    if rows_per_file is not None:
        df = first_rows_per_file(spark, path, rows_per_file, header=True)
    else:
        df = with_file_position(read_csv(spark, path, schema=None, header=True))
    return with_pair_key(strip_blanks(df), pair_on)


def prepare_trips(
    spark: SparkSession,
    trip_path: str,
    fare_path: str,
    rows_per_file: int | None = None,
    pair_on: str | None = None,
) -> DataFrame:
    trip = read_positioned(spark, trip_path, pair_on, rows_per_file)
    fare = read_positioned(spark, fare_path, pair_on, rows_per_file)
    fare_only = [c for c in fare.columns if c not in trip.columns]
    merged = trip.join(fare.select("_pair", "_nth", "row_pos", *fare_only), ["_pair", "_nth", "row_pos"], "full")
    return cast_to_schema(merged, TRIP_SCHEMA)


def match_fares(trip: DataFrame, fare: DataFrame, keys: tuple[str, ...] = RIDE_KEYS) -> DataFrame:
    """Trips and fares joined on ``keys``, whatever the order of files and rows: the 17 trip columns.

    Rides that repeat the keys are numbered on each side in the order of
    their other columns, and the n-th trip meets the n-th fare. Rows without
    a partner stay, with nulls for the other side; a row with a null key has
    no partner. Values of the trip side win for shared names. Instead of a
    join, both sides are stacked and shuffled once, by the keys: numbering and
    pairing both work within them.
    """
    known = {f.name: f.dataType for f in TRIP_SCHEMA.fields}

    def typed(df: DataFrame, columns: list[str], side: int) -> DataFrame:
        return df.select(*[F.col(c).cast(known[c]).alias(c) for c in columns], F.lit(side).alias("_side"))

    of_trip = [c for c in trip.columns if c in known]
    of_fare = [c for c in fare.columns if c in known and (c in keys or c not in of_trip)]
    rest = [c for c in dict.fromkeys(of_trip + of_fare) if c not in keys]
    stacked = union_all([typed(trip, of_trip, 0), typed(fare, of_fare, 1)], allow_missing=True)
    ride = Window.partitionBy(*keys)
    trips_before = F.when(F.col("_side") == 1, F.sum(1 - F.col("_side")).over(ride)).otherwise(0)
    keyed = F.lit(True)
    for k in keys:
        keyed &= F.col(k).isNotNull()
    numbered = stacked.where(keyed).withColumn(
        "_nth", F.row_number().over(ride.orderBy("_side", *rest)) - trips_before
    )
    # a column has a value on one side only
    pairs = numbered.groupBy(*keys, "_nth").agg(*[F.max(c).alias(c) for c in rest])
    rows = union_all([pairs, stacked.where(~keyed)], allow_missing=True)
    absent = {c: F.lit(None) for c in known if c not in rows.columns}
    return cast_to_schema(rows.withColumns(absent) if absent else rows, TRIP_SCHEMA)


def prepare_trips_by_keys(spark: SparkSession, trip_path: str, fare_path: str) -> DataFrame:
    """Trip and fare CSV files with headers, matched by ``RIDE_KEYS``."""
    trip, fare = (strip_blanks(read_csv(spark, p, schema=None, header=True)) for p in (trip_path, fare_path))
    return match_fares(trip, fare)


def read_column_files(spark: SparkSession, root: str, columns: list[str], pair_on: str | None = "chunk") -> DataFrame:
    """Zips one-value-per-line column folders back into rows by position.

    Instead of a chain of joins, the columns are stacked as (key, column,
    value) rows and pivoted back with one aggregate: a single shuffle. Like
    the inner joins of the original, a position must exist in every column.
    """
    parts = []
    for c in columns:
        df = with_pair_key(with_file_position(spark.read.text(f"{root}/{c}")), pair_on)
        parts.append(df.select("_pair", "_nth", "row_pos", F.lit(c).alias("_col"), F.col("value").alias("_v")))
    stacked = union_all(parts)
    picks = [F.max(F.when(F.col("_col") == c, F.col("_v"))).alias(c) for c in columns]
    rows = stacked.groupBy("_pair", "_nth", "row_pos").agg(*picks, F.count(F.lit(1)).alias("_n"))
    return rows.where(F.col("_n") == len(columns)).drop("_n")
