"""Cells, routes and the outlier filter on a trip DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.functions.grid import cell_of_point, route_of_trip, sql

START_AXES = ("start_east", "start_south")
END_AXES = ("end_east", "end_south")
AXES = START_AXES + END_AXES


def with_axes(trips: DataFrame, semantics: str = "observed") -> DataFrame:
    """Adds the four integer axis indices of pickup and drop-off."""
    return trips.withColumns(
        {
            "start_east": F.expr(sql.east_index("pickup_longitude", semantics)),
            "start_south": F.expr(sql.south_index("pickup_latitude", semantics)),
            "end_east": F.expr(sql.east_index("dropoff_longitude", semantics)),
            "end_south": F.expr(sql.south_index("dropoff_latitude", semantics)),
        }
    )


def in_grid_trips(trips: DataFrame, semantics: str = "observed") -> DataFrame:
    """Outlier filter: keeps trips whose both ends are inside the grid.

    The bounding box goes first: on a Parquet or CSV source it reaches the
    reader as pushed filters. The exact rule on the indices follows.
    """
    pre = (
        f"{sql.bbox_prefilter('pickup_latitude', 'pickup_longitude', semantics)} AND "
        f"{sql.bbox_prefilter('dropoff_latitude', 'dropoff_longitude', semantics)}"
    )
    t = with_axes(trips.where(pre), semantics)
    inside = f"{sql.in_grid(*START_AXES, semantics=semantics)} AND {sql.in_grid(*END_AXES, semantics=semantics)}"
    return t.where(inside)


def with_cells(trips: DataFrame, semantics: str = "observed") -> DataFrame:
    """``cell_start``, ``cell_end`` (sentinel outside) and ``route`` columns."""
    return trips.withColumns(
        {
            "cell_start": cell_of_point("pickup_latitude", "pickup_longitude", semantics),
            "cell_end": cell_of_point("dropoff_latitude", "dropoff_longitude", semantics),
            "route": route_of_trip(
                "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", semantics
            ),
        }
    )


def with_axis_codes(df: DataFrame, columns: dict[str, tuple[str, str]], semantics: str = "observed") -> DataFrame:
    """Per-axis indices with the 999 sentinel (the single-axis helpers).

    ``columns`` maps an output name to ``("lat"|"lon", source column)``.
    """
    out = {}
    for name, (axis, src) in columns.items():
        idx = sql.south_index(src, semantics) if axis == "lat" else sql.east_index(src, semantics)
        out[name] = F.expr(sql.axis_or_outside(idx, semantics))
    return df.withColumns(out)


def outlier_filter(trips: DataFrame, semantics: str = "observed") -> DataFrame:
    """Trips with both cells inside, plus the two cell ids (P5 as in the original)."""
    t = in_grid_trips(trips, semantics)
    return t.withColumns(
        {"cell_start": F.expr(sql.cell_id(*START_AXES)), "cell_end": F.expr(sql.cell_id(*END_AXES))}
    ).drop(*AXES)
