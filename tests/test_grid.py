"""Unit layer: grid rules on the edge points of FIXTURES.md §3."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cabgrid.functions import grid as G


def lon(c):
    return G.LON0 + G.DLON * (c + 0.5)


def lat(c):
    return G.LAT0 - G.DLAT * (c + 0.5)


EDGE_POINTS = [
    (41.474937, -74.91358, "0.0"),
    (40.71697, -73.956528, "159.168"),
    (44.2521, -75.9999, "999.999"),
    (0.0, 0.0, "999.999"),
    (lat(-4), lon(150), "150.3"),
    (lat(160), lon(-3), "-3.160"),
    (lat(300), lon(300), "300.300"),
    (lat(301), lon(300), "999.999"),
    (None, -74.0, None),
    (41.0, None, None),
    (float("nan"), -74.0, None),
    (41.0, float("nan"), None),
    (float("inf"), -74.0, "999.999"),
]


def _cells(spark, points, semantics="observed"):
    df = spark.createDataFrame(points, "lat double, lon double, want string")
    rows = df.select(G.cell_of_point("lat", "lon", semantics).alias("cell"), "want").collect()
    return [(r.cell, r.want) for r in rows]


def test_edge_points(spark):
    for got, want in _cells(spark, EDGE_POINTS):
        assert got == want


def test_outlier_filter_drops_non_finite(spark):
    from cabgrid.operators.cells import in_grid_trips

    rows = [
        (lat(160), lon(150), lat(161), lon(151)),
        (float("nan"), lon(150), lat(161), lon(151)),
        (lat(160), float("-inf"), lat(161), lon(151)),
        (lat(160), lon(150), float("inf"), lon(151)),
    ]
    df = spark.createDataFrame(
        rows, "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    )
    assert in_grid_trips(df).count() == 1


def test_axis_sentinel_and_null(spark):
    df = spark.createDataFrame([(lat(301),), (lat(12),), (None,)], "lat double")
    got = [r[0] for r in df.select(G.axis_or_outside(G.sql.south_index("lat"))).collect()]
    assert got == [999, 12, None]


def test_route(spark):
    df = spark.createDataFrame(
        [(lat(160), lon(150), lat(162), lon(151)), (lat(160), lon(150), lat(400), lon(151))],
        "a double, b double, c double, d double",
    )
    got = [r[0] for r in df.select(G.route_of_trip("a", "b", "c", "d")).collect()]
    assert got == ["150.160->151.162", "999.999->999.999"]


def test_intended_grid(spark):
    pts = [
        (G.LAT0, G.LON0, "1.1"),  # origin is the centre of cell 1.1
        (G.LAT0 - 6 * G.DLAT, G.LON0 + 2 * G.DLON, "3.7"),  # 2 east, 6 south of 1.1
        (G.LAT0 + G.DLAT, G.LON0, "999.999"),  # north of the grid: no folding
        (G.LAT0, G.LON0 - G.DLON, "999.999"),  # west of the grid: no negative cells
        (G.LAT0 - 299 * G.DLAT, G.LON0 + 299 * G.DLON, "300.300"),
    ]
    for got, want in _cells(spark, pts, "intended"):
        assert got == want


def test_unknown_semantics_rejected():
    with pytest.raises(ValueError):
        G.south_index("lat", "other")


coords = st.tuples(
    st.floats(min_value=38.0, max_value=45.0, allow_nan=False),
    st.floats(min_value=-78.0, max_value=-71.0, allow_nan=False),
)


@settings(max_examples=30, deadline=None)
@given(st.lists(coords, min_size=1, max_size=200))
def test_bbox_is_superset_of_grid(spark, points):
    df = spark.createDataFrame(points, "lat double, lon double")
    for sem in G.SEMANTICS:
        inside = G.in_grid(G.sql.east_index("lon", sem), G.sql.south_index("lat", sem), sem)
        bad = df.where(inside & ~G.bbox_prefilter("lat", "lon", sem)).count()
        assert bad == 0


def test_cluster_conf_scales_with_input():
    from cabgrid.session import cluster_conf

    small = cluster_conf(10 << 30, 8)
    big = cluster_conf(100 * 10**12, 8000, large_state=True)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) >= 16000
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    assert "RocksDB" in big["spark.sql.streaming.stateStore.providerClass"]


def _cell_py(la, lo):
    """Brute force of the observed rule in plain Python floats (IEEE doubles, like Spark)."""
    import math

    south = math.floor(abs(G.LAT0 - la) / G.DLAT)
    east = math.floor((lo - G.LON0) / G.DLON)
    return f"{east}.{south}" if east <= G.LAST and south <= G.LAST else G.OUTSIDE_CELL


edge = st.tuples(st.integers(-5, 305), st.integers(-5, 305), st.integers(-3, 3), st.integers(-3, 3))


@settings(max_examples=25, deadline=None)
@given(st.lists(edge, min_size=1, max_size=300))
def test_cells_match_brute_force_at_cell_edges(spark, specs):
    import math

    pts = []
    for row, col, dr, dc in specs:
        la = G.LAT0 - row * G.DLAT  # exactly on a row edge, then a few ulps off
        lo = G.LON0 + col * G.DLON
        for _ in range(abs(dr)):
            la = math.nextafter(la, math.copysign(math.inf, dr))
        for _ in range(abs(dc)):
            lo = math.nextafter(lo, math.copysign(math.inf, dc))
        pts.append((la, lo, _cell_py(la, lo)))
    for got, want in _cells(spark, pts):
        assert got == want
