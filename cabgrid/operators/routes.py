"""Route counting and ranking per time window.

Plan shape, for scale:

* ``route_counts`` groups by the window end and the four integer axis
  indices; partial aggregation runs before the shuffle, so a hot route or a
  hot window is combined map-side. The route text is built after the
  aggregate, once per group instead of once per trip.
* ``topk_routes`` filters ``row_number() <= k``; Catalyst turns that into a
  partial ``WindowGroupLimit`` before the exchange, so at most ``k`` rows per
  window and task cross the second shuffle.
* Operators that need every route of a window (running sums, ties, totals)
  go through ``route_count_histogram``: one row per (window, count value).
  A window of N trips has at most about sqrt(2N) distinct count values, so no
  task ever has to hold all routes of a hot window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.functions.grid import route_of_axes
from cabgrid.functions.timewin import micros, pane_windows, window_end
from cabgrid.operators.cells import AXES, in_grid_trips

ROUTE_WINDOW = "30 minutes"


def route_counts(
    trips: DataFrame, length: str = ROUTE_WINDOW, slide: str | None = None, semantics: str = "observed"
) -> DataFrame:
    """Trips per (drop-off window, route): ``window_end, route, count``.

    Sliding windows that are whole numbers of slides add up panes of one
    slide: a trip is counted once, and only the counts are copied into the
    windows that hold their pane.
    """
    panes = slide is not None and micros(length) % micros(slide) == 0
    end = window_end("dropoff_datetime", slide if panes else length, slide)
    t = in_grid_trips(trips, semantics).withColumn("window_end", end)
    counts = t.groupBy("window_end", *AXES).agg(F.count(F.lit(1)).alias("count"))
    if panes and length != slide:
        counts = counts.withColumn("window_end", F.explode(pane_windows("window_end", length, slide)))
        counts = counts.groupBy("window_end", *AXES).agg(F.sum("count").alias("count"))
    return counts.select("window_end", route_of_axes(*AXES).alias("route"), "count")


def topk_routes(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent routes per window; ties by route text ascending."""
    w = Window.partitionBy("window_end").orderBy(F.desc("count"), F.asc("route"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("route", "count", "rank", "window_end")
    )


def route_count_histogram(counts: DataFrame) -> DataFrame:
    """``window_end, count, n_routes, first_route``: routes per count value."""
    return counts.groupBy("window_end", "count").agg(
        F.count(F.lit(1)).alias("n_routes"), F.min("route").alias("first_route")
    )


def window_trip_totals(counts: DataFrame, semantics: str = "observed") -> DataFrame:
    """One row per window: ``route, count, trips_per_window, window_end``.

    The kept row is the top route (ties by route text). ``observed`` gives
    the original's running sum at that row: a sum over the count-ordered
    window with the default RANGE frame, which covers the top count and its
    ties only, so it equals top count x tied routes. ``intended`` gives the
    real number of trips in the window.
    """
    hist = route_count_histogram(counts)
    per_window = hist.groupBy("window_end").agg(
        F.max_by(F.struct("count", "n_routes", "first_route"), "count").alias("top"),
        F.sum(F.col("count") * F.col("n_routes")).alias("total"),
    )
    if semantics == "observed":
        trips = F.col("top.count") * F.col("top.n_routes")
    elif semantics == "intended":
        trips = F.col("total")
    else:
        raise ValueError(semantics)
    return per_window.select(
        F.col("top.first_route").alias("route"),
        F.col("top.count").alias("count"),
        trips.alias("trips_per_window"),
        "window_end",
    )


def running_route_trips(counts: DataFrame) -> DataFrame:
    """Every (window, route) row with ``sum(count)`` over ``count desc``, RANGE frame.

    The RANGE frame sums all routes whose count is at least this row's; that
    is computed on the histogram and joined back on (window, count). The
    joined side is one row per count value; AQE broadcasts it when its
    measured size allows, and splits a skewed (window, count) key otherwise.
    """
    hist = route_count_histogram(counts)
    w = Window.partitionBy("window_end").orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.select("window_end", "count", F.sum(F.col("count") * F.col("n_routes")).over(w).alias("running_trips"))
    return counts.join(cum, ["window_end", "count"]).select("route", "count", "running_trips", "window_end")


def rank_routes_with_ties(counts: DataFrame, k: int = 10) -> DataFrame:
    """``rank() <= k`` per window: equal counts share a rank, so ties are all kept.

    The rank of a count value is 1 + routes with a higher count, read off the
    histogram; at most ``k`` count values per window survive, and the routes
    join back to them.
    """
    hist = route_count_histogram(counts)
    w = Window.partitionBy("window_end").orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select(
        "window_end",
        "count",
        (F.coalesce(F.sum("n_routes").over(w), F.lit(0)) + 1).cast("int").alias("rank"),
    ).where(F.col("rank") <= k)
    return counts.join(ranks, ["window_end", "count"]).select("route", "count", "rank", "window_end")


def frequent_routes_overall(counts: DataFrame) -> DataFrame:
    """Rows of the windowed frame per route, most frequent first.

    Counting rows of the (window, route) frame gives the number of windows a
    route appears in.
    """
    return (
        counts.groupBy("route")
        .agg(F.count(F.lit(1)).alias("n_windows"))
        .orderBy(F.desc("n_windows"), F.asc("route"))
    )


def distinct_windows(
    trips: DataFrame, length: str = ROUTE_WINDOW, semantics: str = "observed"
) -> DataFrame:
    """Window ends that hold at least one in-grid trip."""
    t = in_grid_trips(trips, semantics)
    return t.select(window_end("dropoff_datetime", length).alias("window_end")).distinct()


def route_counts_by_window(trips: DataFrame, length: str = ROUTE_WINDOW, semantics: str = "observed") -> DataFrame:
    """Counts keyed by the ``window`` struct (start, end) as ``window()`` returns it."""
    t = in_grid_trips(trips, semantics)
    return (
        t.groupBy(F.window("dropoff_datetime", length).alias("window"), *AXES)
        .agg(F.count(F.lit(1)).alias("count"))
        .select("window", route_of_axes(*AXES).alias("route"), "count")
    )
