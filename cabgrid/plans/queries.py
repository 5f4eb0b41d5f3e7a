"""The user-facing queries (Q1-Q3): compositions of the operators.

Functions take and return DataFrames; they never create a session and never
collect. Each output is one lazy plan, so a caller that writes two of them
from the same counts should ``persist`` or ``checkpoint`` the counts first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cabgrid.operators import areas, profiles, routes


def frequent_routes(
    trips: DataFrame,
    k: int = 10,
    length: str = routes.ROUTE_WINDOW,
    slide: str | None = None,
    semantics: str = "observed",
) -> DataFrame:
    """Q1: ``route, count, rank, window_end`` for the top ``k`` routes per window."""
    return routes.topk_routes(routes.route_counts(trips, length, slide, semantics), k)


def window_trip_totals(
    trips: DataFrame, length: str = routes.ROUTE_WINDOW, semantics: str = "observed", slide: str | None = None
) -> DataFrame:
    """``route, count, trips_per_window, window_end``, one row per window."""
    return routes.window_trip_totals(routes.route_counts(trips, length, slide, semantics), semantics)


def profitable_cells(
    trips: DataFrame,
    k: int = 10,
    length: str = areas.AREA_WINDOW,
    max_secs: int | None = areas.SHORT_TRIP_SECS,
    semantics: str = "observed",
    slide: str | None = None,
) -> DataFrame:
    """Q2: ``window, cell, profitability, rank`` for the top ``k`` cells per window."""
    return areas.topk_cells(areas.profitability(trips, length, max_secs, semantics=semantics, slide=slide), k)


def profitability_per_window(
    trips: DataFrame,
    length: str = areas.AREA_WINDOW,
    max_secs: int | None = areas.SHORT_TRIP_SECS,
    semantics: str = "observed",
    slide: str | None = None,
) -> DataFrame:
    """``window, avg_profitability``."""
    prof = areas.profitability(trips, length, max_secs, semantics=semantics, slide=slide)
    return areas.profitability_per_window(prof)


def daytime_profile(trips: DataFrame, k: int = 10, length: str = routes.ROUTE_WINDOW) -> DataFrame:
    """Q3: top routes per time of day, from the Q1 ranking."""
    return profiles.route_daytime_profile(frequent_routes(trips, k, length), k)
