"""Exact grouped medians from counts per distinct value.

Equal values of a group meet in one (key, value, count) row, counted by a
plain hash aggregate that combines map-side. A running sum over the values of
a group then finds the value at which it reaches half of the group. Only
distinct values cross the second shuffle, a group is sorted with spilling, and
nothing is approximate however large a group grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def median_of_counts(counts: DataFrame, keys: list[str], value: str, n: str, *aggs: Column, name: str = "median") -> DataFrame:
    """``keys``, ``aggs`` over the rows of a group, and the group's discrete median.

    The median of N values is the smallest one with at least N / 2 values up
    to it: an element of the group, not interpolated (``quantile_disc``). A
    value may come in several rows; rows without a value do not count (a group
    without values has a null median); NaN is the largest value.
    """
    group = Window.partitionBy(*keys)
    so_far = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.when(F.col(value).isNotNull(), F.col(n)).otherwise(0)
    reached = 2 * F.sum(weight).over(so_far) >= F.sum(weight).over(group)
    return (
        counts.withColumn("_at", F.when(reached, F.col(value)))
        .groupBy(*keys)
        .agg(*aggs, F.min("_at").alias(name))
    )
