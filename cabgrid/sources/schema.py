"""The trip record: 17 declared, nullable fields, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TRIP_COLUMNS = [
    "medallion",
    "hack_license",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "payment_type",
    "fare_amount",
    "surcharge",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]

_TYPES = {
    "medallion": T.StringType(),
    "hack_license": T.StringType(),
    "trip_time_in_secs": T.IntegerType(),
    "payment_type": T.StringType(),
}

# The five columns the column-per-directory stream carries.
COLUMN_STREAM_COLUMNS = [
    "dropoff_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]


def trip_schema(ts_type: T.DataType | None = None, columns: list[str] | None = None) -> T.StructType:
    """Declared trip schema.

    Batch reads use ``TIMESTAMP_NTZ`` (zone-free, like the source files);
    streams need ``TIMESTAMP`` because watermarks refuse NTZ.
    """
    ts_type = ts_type or T.TimestampNTZType()
    fields = []
    for name in columns or TRIP_COLUMNS:
        if name.endswith("_datetime"):
            dtype = ts_type
        else:
            dtype = _TYPES.get(name, T.DoubleType())
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


TRIP_SCHEMA = trip_schema()
STREAM_TRIP_SCHEMA = trip_schema(T.TimestampType())

# Ranked routes as the CSV sink writes them: route, count, rank, window end.
RANKING_SCHEMA = T.StructType(
    [
        T.StructField("route", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("window_end", T.TimestampNTZType()),
    ]
)
