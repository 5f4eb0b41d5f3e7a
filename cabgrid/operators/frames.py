"""Frame-level helpers: struct flattening and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_structs(df: DataFrame) -> DataFrame:
    """Top-level struct columns become ``<struct>_<field>`` columns, after the flat ones."""
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
    nested = [
        F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}_{g.name}")
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType)
        for g in f.dataType.fields
    ]
    return df.select(*[F.col(f"`{c}`") for c in flat], *nested)


def frame_shape(df: DataFrame) -> DataFrame:
    """``n_rows, n_cols`` as a one-row DataFrame; the count runs distributed."""
    return df.select(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))
