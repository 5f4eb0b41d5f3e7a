"""Trips derived from the ``events`` test table.

The test tables hold no taxi data, so each event becomes one trip by integer
arithmetic that DuckDB reproduces exactly (see FIXTURES.md §2). All columns
are lazy expressions: a query that needs five columns computes five, and the
Parquet scan reads only the event columns behind them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from cabgrid.functions.grid import DLAT, DLON, LAT0, LON0
from cabgrid.sources.schema import TRIP_COLUMNS

# Fixed values of the fixture formula.
BASE_TIME = "2024-01-01 00:00:00"


def _lon(c: str) -> str:
    """Longitude of the middle of grid column ``c`` (SQL text, double literals)."""
    return f"({LON0!r}D + {DLON!r}D * (({c}) + 0.5D))"


def _lat(c: str) -> str:
    """Latitude of the middle of grid row ``c``."""
    return f"({LAT0!r}D - {DLAT!r}D * (({c}) + 0.5D))"


_E, _U = "event_id", "user_id"
_TRIP_TIME = f"CAST(120 + ({_E} * 7919) % 1680 AS INT)"
_DROPOFF = f"timestampadd(SECOND, 3600 + {_E} * 13 + {_U} % 7, TIMESTAMP_NTZ '{BASE_TIME}')"
_TIP = f"({_E} % 7) * 0.5D"

# One SQL expression per trip column: a single ``selectExpr`` builds the
# whole projection in one call instead of hundreds of small Column calls.
TRIP_EXPRS = {
    "trip_id": _E,
    "medallion": f"CAST({_U} AS STRING)",
    "hack_license": f"CAST({_U} AS STRING)",
    "pickup_datetime": f"timestampadd(SECOND, -{_TRIP_TIME}, {_DROPOFF})",
    "dropoff_datetime": _DROPOFF,
    "trip_time_in_secs": _TRIP_TIME,
    "trip_distance": f"{_TRIP_TIME} / 300.0D",
    "pickup_longitude": f"CASE WHEN {_E} % 97 = 0 THEN 0.0D WHEN {_E} % 103 = 0 THEN {_lon('-3')} "
    f"ELSE {_lon(f'150 + ({_E} * 31 + {_U}) % 4')} END",
    "pickup_latitude": f"CASE WHEN {_E} % 97 = 0 THEN 0.0D WHEN {_E} % 101 = 0 THEN {_lat('-4')} "
    f"WHEN {_E} % 211 = 0 THEN CAST(NULL AS DOUBLE) ELSE {_lat(f'160 + ({_E} * 17 + {_U} * 3) % 3')} END",
    "dropoff_longitude": _lon(f"150 + ({_E} * 7 + {_U} * 5) % 4"),
    "dropoff_latitude": _lat(f"160 + ({_U} + {_E}) % 3"),
    "payment_type": "event_type",
    "fare_amount": "value",
    "surcharge": "0.5D",
    "mta_tax": "0.5D",
    "tip_amount": _TIP,
    "tolls_amount": "0.0D",
    "total_amount": f"value + {_TIP} + 1.0D",
}


def trips_from_events(events: DataFrame, with_id: bool = True) -> DataFrame:
    names = (["trip_id"] if with_id else []) + TRIP_COLUMNS
    return events.selectExpr(*[f"{TRIP_EXPRS[n]} AS {n}" for n in names])


EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def load_trips(spark, sf_dir: str, with_id: bool = True) -> DataFrame:
    """Trips of one test scale, e.g. ``/root/testdata/sf0.01`` (declared schema, no inference)."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return trips_from_events(events, with_id)


# --- trips as files, for the file-based operators -------------------------
#
# The original reads trip and fare CSV files, one value per line column
# files and a folder of CSV files for its stream. These writers produce that
# layout from any trip DataFrame with Spark: ``<dir>/chunk=<k>/part-*.csv``
# holds trips with ``trip_id div rows_per_file = k`` in ``trip_id`` order.
# One file is written by one task, and a chunk holds at most
# ``rows_per_file`` rows whatever the data size: no task gets an unbounded
# group.

TRIP_SIDE = TRIP_COLUMNS[:10]  # medallion .. dropoff_latitude
FARE_SIDE = ["medallion", "hack_license", "pickup_datetime"] + TRIP_COLUMNS[10:]
ROWS_PER_FILE = 2500


def _chunked(trips: DataFrame, rows_per_file: int) -> DataFrame:
    # Sorting by (chunk, trip_id) also satisfies the writer's ordering by the
    # partition column, so no second sort can reorder rows inside a file.
    t = trips.withColumn("chunk", F.expr(f"trip_id div {int(rows_per_file)}"))
    return t.repartition("chunk").sortWithinPartitions("chunk", "trip_id")


def write_trip_fare_files(
    trips: DataFrame, trip_dir: str, fare_dir: str, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Trip files and fare files with headers, paired by folder and row position.

    Fare headers after the first carry a leading blank, as in the public
    fare files; the writer must not trim them. Both writes share one shuffle
    (persisted; lost blocks are recomputed from lineage).
    """
    t = _chunked(trips, rows_per_file).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        t.select("chunk", *TRIP_SIDE).write.partitionBy("chunk").option("header", True).csv(trip_dir)
        fare = t.select("chunk", *[F.col(c).alias(c if i == 0 else f" {c}") for i, c in enumerate(FARE_SIDE)])
        fare.write.partitionBy("chunk").option("header", True).option("ignoreLeadingWhiteSpace", False).csv(fare_dir)
    finally:
        t.unpersist()


def write_unordered_trip_fare_files(
    trips: DataFrame, trip_dir: str, fare_dir: str, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """As ``write_trip_fare_files``, but rows lie in other files and another order on each side."""
    mixed = lambda seed: F.xxhash64("trip_id", F.lit(seed))
    n_files = F.ceil((F.max("trip_id") + 1) / F.lit(rows_per_file)).alias("n_files")
    sides = [(TRIP_SIDE, trip_dir, 1), (FARE_SIDE, fare_dir, 2)]
    for side, path, seed in sides:
        t = trips.join(F.broadcast(trips.agg(n_files)), F.lit(True)).withColumn("chunk", F.pmod(mixed(seed), "n_files"))
        t = t.repartition("chunk").sortWithinPartitions("chunk", mixed(seed))
        named = [F.col(c).alias(c if i == 0 or side is TRIP_SIDE else f" {c}") for i, c in enumerate(side)]
        t.select("chunk", *named).write.partitionBy("chunk").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).csv(path)


def write_column_files(trips: DataFrame, root: str, columns: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per column, one value per line (``<root>/<column>/chunk=.../``)."""
    t = _chunked(trips.select("trip_id", *columns), rows_per_file).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for c in columns:
            t.select("chunk", F.col(c).cast("string").alias("value")).write.partitionBy("chunk").text(f"{root}/{c}")
    finally:
        t.unpersist()


def write_stream_files(
    trips: DataFrame,
    path: str,
    columns: list[str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "errorifexists",
) -> None:
    """Headerless CSV files for a file stream; timestamps as UTC text with ``Z``."""
    from cabgrid.functions.timewin import utc_text

    t = _chunked(trips, rows_per_file)
    cols = [utc_text(c).alias(c) if c.endswith("_datetime") else F.col(c) for c in (columns or TRIP_COLUMNS)]
    t.select("chunk", *cols).write.mode(mode).partitionBy("chunk").csv(path)
