"""Time-of-day profiles over ranked windows.

Inputs are already small (top-k rows or one row per window); the profile
groups them by ``HH:mm`` of the window end, so it stays distributed and never
goes through the driver.

Outputs are sorted with a global ``orderBy`` (range partitioning). A
profile has at most one row per minute of the day and ranked item, so this
last sort is small whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.functions.timewin import time_of_day


def _mean(value: str, digits: int | None):
    return F.avg(value) if digits is None else F.round(F.avg(value), digits)


def _local_rank(df: DataFrame, key: str, value: str, item: str, k: int | None) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(value), F.asc(item))
    out = df.withColumn("local_rank", F.row_number().over(w))
    if k is not None:
        out = out.where(F.col("local_rank") <= k)
    return out.orderBy(key, "local_rank")


def route_daytime_profile(ranked: DataFrame, k: int | None = 10) -> DataFrame:
    """``endtime, route, avg_count, local_rank`` from ranked routes."""
    prof = ranked.groupBy(time_of_day("window_end").alias("endtime"), "route").agg(
        F.avg("count").alias("avg_count")
    )
    return _local_rank(prof, "endtime", "avg_count", "route", k)


def busiest_times(totals: DataFrame) -> DataFrame:
    """``endtime, avg_top_count``: mean count of the kept row per time of day."""
    prof = totals.groupBy(time_of_day("window_end").alias("endtime")).agg(F.avg("count").alias("avg_top_count"))
    return prof.orderBy("endtime")


def cell_daytime_profile(ranked_cells: DataFrame, k: int | None = 10, digits: int | None = None) -> DataFrame:
    """``time, cell, avg_profitability, local_rank`` from ranked cells.

    With ``digits``, means are rounded before they are ranked, so that the
    order of summation cannot decide a rank.
    """
    prof = ranked_cells.groupBy(time_of_day("window").alias("time"), "cell").agg(
        _mean("profitability", digits).alias("avg_profitability")
    )
    return _local_rank(prof, "time", "avg_profitability", "cell", k)


def profitable_times(per_window: DataFrame, digits: int | None = None) -> DataFrame:
    """``time, avg_profitability``: mean of window means per time of day."""
    prof = per_window.groupBy(time_of_day("window").alias("time")).agg(
        _mean("avg_profitability", digits).alias("avg_profitability")
    )
    return prof.orderBy("time")
