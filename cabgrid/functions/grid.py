"""Grid cells and routes as native column expressions.

Each rule is written once, as a Spark SQL expression over its inputs
(column names or other SQL expressions), and returned as a ``Column`` through
one ``F.expr``. Nothing leaves the JVM: the expressions stay inside
whole-stage codegen and Catalyst folds the constants. Composite rules nest
the text, so building a whole outlier filter costs one call to the JVM, not
hundreds of small ``Column`` calls. Two rule sets exist:

* ``observed``: what the original scripts compute. South index from the
  absolute latitude distance (points north of the origin fold south), no
  lower bound on the east index, 0..300 inclusive accepted.
* ``intended``: what their comments describe. Cell 1.1 is centred on the
  origin, indices run 1..300, anything else is outside.

A null or NaN coordinate gives a null index, a null cell and a null route;
the outlier filter drops such rows, and rows with infinite coordinates.
Division is by the cell size, never multiplication by its inverse, so
boundary points round like the original.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the original grid for equal cells.
LAT0 = 41.474937  # latitude of the grid origin
LON0 = -74.91358  # longitude of the grid origin
DLAT = 0.004491556  # cell height in degrees of latitude (500 m)
DLON = 0.005986  # cell width in degrees of longitude (500 m)
LAST = 300  # last accepted index on each axis
OUTSIDE_CELL = "999.999"  # cell id of a point outside the grid
OUTSIDE_ROUTE = "999.999->999.999"  # route id when either end is outside
OUTSIDE_INDEX = 999  # axis index of a point outside the grid

SEMANTICS = ("observed", "intended")

# Degrees of slack for the bounding-box prefilter, far above double rounding.
_MARGIN = 1e-6


def _check(semantics: str) -> None:
    if semantics not in SEMANTICS:
        raise ValueError(f"semantics must be one of {SEMANTICS}, got {semantics!r}")


def _d(x: float) -> str:
    """A double literal in Spark SQL (a bare 41.47 would be a DECIMAL)."""
    return f"{x!r}D"


def _not_nan(x: str) -> str:
    """``x`` with NaN as null, referencing ``x`` once.

    ``FLOOR(NaN)`` is 0 in Spark: a NaN coordinate would land in a real cell.
    (An infinite one gives an index beyond the grid, except a longitude of
    -Infinity in the observed rule, which has no lower east bound; the
    outlier filter's bounding box drops it.)
    """
    return f"nanvl({x}, CAST(NULL AS DOUBLE))"


class sql:
    """The rules as Spark SQL text; arguments are SQL expressions (e.g. column names)."""

    @staticmethod
    def south_index(lat: str, semantics: str = "observed") -> str:
        _check(semantics)
        lat = _not_nan(lat)
        if semantics == "observed":
            return f"FLOOR(ABS({_d(LAT0)} - {lat}) / {_d(DLAT)})"
        return f"(FLOOR(({_d(LAT0)} - {lat}) / {_d(DLAT)} + 0.5D) + 1)"

    @staticmethod
    def east_index(lon: str, semantics: str = "observed") -> str:
        _check(semantics)
        lon = _not_nan(lon)
        if semantics == "observed":
            return f"FLOOR(({lon} - {_d(LON0)}) / {_d(DLON)})"
        return f"(FLOOR(({lon} - {_d(LON0)}) / {_d(DLON)} + 0.5D) + 1)"

    @staticmethod
    def index_in_grid(idx: str, semantics: str = "observed") -> str:
        _check(semantics)
        return f"(({idx}) <= {LAST})" if semantics == "observed" else f"(({idx}) BETWEEN 1 AND {LAST})"

    @staticmethod
    def in_grid(east: str, south: str, semantics: str = "observed") -> str:
        return f"({sql.index_in_grid(east, semantics)} AND {sql.index_in_grid(south, semantics)})"

    @staticmethod
    def axis_or_outside(idx: str, semantics: str = "observed") -> str:
        return f"CASE WHEN NOT {sql.index_in_grid(idx, semantics)} THEN {OUTSIDE_INDEX} ELSE ({idx}) END"

    @staticmethod
    def cell_id(east: str, south: str) -> str:
        return f"CONCAT(CAST(({east}) AS STRING), '.', CAST(({south}) AS STRING))"

    @staticmethod
    def cell_or_outside(east: str, south: str, semantics: str = "observed") -> str:
        inside = sql.in_grid(east, south, semantics)
        return f"CASE WHEN {inside} THEN {sql.cell_id(east, south)} WHEN NOT {inside} THEN '{OUTSIDE_CELL}' END"

    @staticmethod
    def route_of_axes(se: str, ss: str, ee: str, es: str) -> str:
        return f"CONCAT({sql.cell_id(se, ss)}, '->', {sql.cell_id(ee, es)})"

    @staticmethod
    def route_of_trip(lat1: str, lon1: str, lat2: str, lon2: str, semantics: str = "observed") -> str:
        se, ss = sql.east_index(lon1, semantics), sql.south_index(lat1, semantics)
        ee, es = sql.east_index(lon2, semantics), sql.south_index(lat2, semantics)
        inside = f"({sql.in_grid(se, ss, semantics)} AND {sql.in_grid(ee, es, semantics)})"
        return (
            f"CASE WHEN {inside} THEN {sql.route_of_axes(se, ss, ee, es)} "
            f"WHEN NOT {inside} THEN '{OUTSIDE_ROUTE}' END"
        )

    @staticmethod
    def bbox_prefilter(lat: str, lon: str, semantics: str = "observed") -> str:
        _check(semantics)
        if semantics == "observed":
            span = (LAST + 1) * DLAT + _MARGIN
            lat_ok = f"(({lat}) BETWEEN {_d(LAT0 - span)} AND {_d(LAT0 + span)})"
            lon_ok = f"({lon}) > double('-Infinity') AND ({lon}) < {_d(LON0 + (LAST + 1) * DLON + _MARGIN)}"
            return f"({lat_ok} AND {lon_ok})"
        lat_lo, lat_hi = LAT0 - (LAST - 0.5) * DLAT - _MARGIN, LAT0 + 0.5 * DLAT + _MARGIN
        lon_lo, lon_hi = LON0 - 0.5 * DLON - _MARGIN, LON0 + (LAST - 0.5) * DLON + _MARGIN
        return (
            f"(({lat}) BETWEEN {_d(lat_lo)} AND {_d(lat_hi)} AND ({lon}) BETWEEN {_d(lon_lo)} AND {_d(lon_hi)})"
        )


# --- the same rules as Columns ---------------------------------------------


def south_index(lat: str, semantics: str = "observed") -> Column:
    """Row of the grid (second cell component), as bigint."""
    return F.expr(sql.south_index(lat, semantics))


def east_index(lon: str, semantics: str = "observed") -> Column:
    """Column of the grid (first cell component), as bigint."""
    return F.expr(sql.east_index(lon, semantics))


def index_in_grid(idx: str, semantics: str = "observed") -> Column:
    """True when one axis index is inside the grid; null for a null index."""
    return F.expr(sql.index_in_grid(idx, semantics))


def in_grid(east: str, south: str, semantics: str = "observed") -> Column:
    return F.expr(sql.in_grid(east, south, semantics))


def axis_or_outside(idx: str, semantics: str = "observed") -> Column:
    """Axis index, or 999 outside the grid (per-axis helpers of the original)."""
    return F.expr(sql.axis_or_outside(idx, semantics))


def cell_id(east: str, south: str) -> Column:
    """``"<east>.<south>"``; null when either index is null."""
    return F.expr(sql.cell_id(east, south))


def cell_or_outside(east: str, south: str, semantics: str = "observed") -> Column:
    """Cell id, the sentinel ``999.999`` outside the grid, null for null input."""
    return F.expr(sql.cell_or_outside(east, south, semantics))


def cell_of_point(lat: str, lon: str, semantics: str = "observed") -> Column:
    return F.expr(sql.cell_or_outside(sql.east_index(lon, semantics), sql.south_index(lat, semantics), semantics))


def route_of_axes(se: str, ss: str, ee: str, es: str) -> Column:
    """Route id from the four axis indices of two in-grid points."""
    return F.expr(sql.route_of_axes(se, ss, ee, es))


def route_of_trip(lat1: str, lon1: str, lat2: str, lon2: str, semantics: str = "observed") -> Column:
    """``"<start>-><end>"`` when both ends are inside, else the outside route."""
    return F.expr(sql.route_of_trip(lat1, lon1, lat2, lon2, semantics))


def bbox_prefilter(lat: str, lon: str, semantics: str = "observed") -> Column:
    """A cheap superset of ``in_grid`` on raw coordinates.

    Plain range predicates on source columns reach the Parquet/CSV reader as
    pushed filters (row-group skipping), which predicates on computed cell
    ids never do. It must never drop a row the grid keeps, hence the margin.
    """
    return F.expr(sql.bbox_prefilter(lat, lon, semantics))
