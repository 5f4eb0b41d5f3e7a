"""DuckDB SQL equal to each registered query, over the same parquet views.

Written independently of the Spark plans, in the most literal form: window
functions with the default RANGE frame, left joins and ``quantile_disc`` for
``percentile_approx``. Grid constants are cast to DOUBLE so both engines do
the same double arithmetic.
"""

from __future__ import annotations

from cabgrid.sources.fixture import FARE_SIDE, ROWS_PER_FILE, TRIP_SIDE

FILE_ROW_LIMIT = 2000  # equal to entrypoints.FILE_ROW_LIMIT


def _lon(c: str) -> str:
    return f"(-74.91358::DOUBLE + 0.005986::DOUBLE * (({c}) + 0.5::DOUBLE))"


def _lat(c: str) -> str:
    return f"(41.474937::DOUBLE - 0.004491556::DOUBLE * (({c}) + 0.5::DOUBLE))"


TRIPS = f"""
trips AS (
  SELECT e AS trip_id,
    CAST(u AS VARCHAR) AS medallion,
    CAST(u AS VARCHAR) AS hack_license,
    d - to_seconds(tt) AS pickup_datetime,
    d AS dropoff_datetime,
    tt AS trip_time_in_secs,
    tt / 300.0::DOUBLE AS trip_distance,
    CASE WHEN e % 97 = 0 THEN 0.0::DOUBLE
         WHEN e % 103 = 0 THEN {_lon("-3")}
         ELSE {_lon("150 + (e * 31 + u) % 4")} END AS pickup_longitude,
    CASE WHEN e % 97 = 0 THEN 0.0::DOUBLE
         WHEN e % 101 = 0 THEN {_lat("-4")}
         WHEN e % 211 = 0 THEN NULL
         ELSE {_lat("160 + (e * 17 + u * 3) % 3")} END AS pickup_latitude,
    {_lon("150 + (e * 7 + u * 5) % 4")} AS dropoff_longitude,
    {_lat("160 + (u + e) % 3")} AS dropoff_latitude,
    event_type AS payment_type,
    value AS fare_amount,
    0.5::DOUBLE AS surcharge,
    0.5::DOUBLE AS mta_tax,
    (e % 7) * 0.5::DOUBLE AS tip_amount,
    0.0::DOUBLE AS tolls_amount,
    value + (e % 7) * 0.5::DOUBLE + 1.0::DOUBLE AS total_amount
  FROM (
    SELECT event_id AS e, user_id AS u, event_type, value,
      CAST(120 + (event_id * 7919) % 1680 AS INTEGER) AS tt,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(3600 + event_id * 13 + user_id % 7) AS d
    FROM events))"""


def _east(lon: str, intended: bool = False) -> str:
    if intended:
        return f"CAST(floor(({lon} - (-74.91358::DOUBLE)) / 0.005986::DOUBLE + 0.5::DOUBLE) AS BIGINT) + 1"
    return f"CAST(floor(({lon} - (-74.91358::DOUBLE)) / 0.005986::DOUBLE) AS BIGINT)"


def _south(lat: str, intended: bool = False) -> str:
    if intended:
        return f"CAST(floor((41.474937::DOUBLE - {lat}) / 0.004491556::DOUBLE + 0.5::DOUBLE) AS BIGINT) + 1"
    return f"CAST(floor(abs(41.474937::DOUBLE - {lat}) / 0.004491556::DOUBLE) AS BIGINT)"


def _grid(intended: bool = False) -> str:
    ok = "BETWEEN 1 AND 300" if intended else "<= 300"
    return f"""
grid AS (
  SELECT *,
    {_east("pickup_longitude", intended)} AS se,
    {_south("pickup_latitude", intended)} AS ss,
    {_east("dropoff_longitude", intended)} AS ee,
    {_south("dropoff_latitude", intended)} AS es
  FROM trips),
ig AS (
  SELECT * FROM grid WHERE se {ok} AND ss {ok} AND ee {ok} AND es {ok})"""


def _cell(e: str, s: str) -> str:
    return f"(CAST({e} AS VARCHAR) || '.' || CAST({s} AS VARCHAR))"


ROUTE = f"({_cell('se', 'ss')} || '->' || {_cell('ee', 'es')})"


def _bucket_end(ts: str, minutes: int) -> str:
    return f"(time_bucket(INTERVAL '{minutes} minutes', {ts}) + INTERVAL '{minutes} minutes')"


def _bucket_start(ts: str, minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {ts})"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _rc() -> str:
    return f"""
rc AS (
  SELECT {_bucket_end("dropoff_datetime", 30)} AS window_end, {ROUTE} AS route, count(*) AS "count"
  FROM ig GROUP BY ALL)"""


BASE = _with(TRIPS, _grid(), _rc())
BASE_INTENDED = _with(TRIPS, _grid(True), _rc())

TOPK_ROUTES = """
topk AS (
  SELECT route, "count", CAST(rn AS INTEGER) AS rank, window_end FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, route) AS rn FROM rc)
  WHERE rn <= {k})"""

TOTALS = """
totals AS (
  SELECT route, "count", trips_per_window, window_end FROM (
    SELECT route, "count", window_end,
      CAST(sum("count") OVER (PARTITION BY window_end ORDER BY "count" DESC
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS trips_per_window,
      row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, route) AS rn
    FROM rc)
  WHERE rn = 1)"""

AREAS = f"""
drops AS (
  SELECT {_bucket_end("dropoff_datetime", 15)} AS "window", {_cell("ee", "es")} AS cell, count(*) AS dropoff_count
  FROM ig GROUP BY ALL),
picks AS (
  SELECT {_bucket_start("pickup_datetime", 15)} AS "window", {_cell("se", "ss")} AS cell, count(*) AS pickup_count
  FROM ig GROUP BY ALL),
empty AS (
  SELECT "window", cell, empty_cabs FROM (
    SELECT d."window", d.cell, d.dropoff_count - coalesce(p.pickup_count, 0) AS empty_cabs
    FROM drops d LEFT JOIN picks p ON d."window" = p."window" AND d.cell = p.cell)
  WHERE empty_cabs > 0),
profit AS (
  SELECT {_bucket_end("dropoff_datetime", 15)} AS "window", {_cell("se", "ss")} AS cell,
    quantile_disc(fare_amount + tip_amount, 0.5) AS profit
  FROM ig WHERE {{short}} GROUP BY ALL),
prof AS (
  SELECT e."window", e.cell, p.profit / e.empty_cabs AS profitability
  FROM empty e JOIN profit p ON e."window" = p."window" AND e.cell = p.cell),
topc AS (
  SELECT "window", cell, profitability, CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY "window" ORDER BY profitability DESC, cell) AS rn FROM prof)
  WHERE rn <= {{k}}),
perwin AS (
  SELECT "window", avg(profitability) AS avg_profitability FROM prof GROUP BY "window")"""


def _in_windows(ts: str, step: int, length: int) -> str:
    """The ends of the ``length``-minute windows every ``step`` minutes that hold ``ts``.

    One row per window end, by ``unnest`` in the select list: the multiples of
    ``step`` in (ts, ts + length], ``length / step`` of them.
    """
    first = f"time_bucket(INTERVAL '{step} minutes', {ts}) + INTERVAL '{step} minutes'"
    return f"unnest(generate_series({first}, {first} + to_minutes({length - step}), INTERVAL '{step} minutes'))"


def _empty_intended(step: int = 15, horizon: int = 30) -> str:
    """Intended empty taxis, evaluated every ``step`` minutes over the last ``horizon``."""
    return f"""
dwin AS (
  SELECT medallion, {_in_windows("dropoff_datetime", step, horizon)} AS "window", dropoff_datetime, ee, es
  FROM ig),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "window", medallion
                                 ORDER BY dropoff_datetime DESC, ee DESC, es DESC) AS rn FROM dwin)
  WHERE rn = 1),
idle AS (
  SELECT * FROM latest l WHERE NOT EXISTS (
    SELECT 1 FROM ig p WHERE p.medallion = l.medallion
      AND p.pickup_datetime > l.dropoff_datetime AND p.pickup_datetime < l."window")),
empty AS (
  SELECT "window", {_cell("ee", "es")} AS cell, count(*) AS empty_cabs FROM idle GROUP BY ALL)"""


def _areas_intended(k: int = 10, length: int = 15, step: int = 15) -> str:
    """Intended profitability: all trips, profit over the last ``length`` minutes every ``step``."""
    return f"""
pwin AS (
  SELECT {_in_windows("dropoff_datetime", step, length)} AS "window", {_cell("se", "ss")} AS cell,
    fare_amount + tip_amount AS revenue
  FROM ig),
profit AS (
  SELECT "window", cell, quantile_disc(revenue, 0.5) AS profit FROM pwin GROUP BY ALL),
prof AS (
  SELECT e."window", e.cell, p.profit / e.empty_cabs AS profitability
  FROM empty e JOIN profit p ON e."window" = p."window" AND e.cell = p.cell),
topc AS (
  SELECT "window", cell, profitability, CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY "window" ORDER BY profitability DESC, cell) AS rn FROM prof)
  WHERE rn <= {k})"""


def _areas_sliding(length: int = 15, step: int = 5) -> str:
    """The observed rule over ``length`` minutes, every ``step`` minutes: drop-offs before T, pickups from T on."""
    return f"""
dwin AS (
  SELECT {_in_windows("dropoff_datetime", step, length)} AS "window", {_cell("ee", "es")} AS cell FROM ig),
pwin AS (
  SELECT {_in_windows("pickup_datetime", step, length)} AS window_end, {_cell("se", "ss")} AS cell FROM ig),
rwin AS (
  SELECT {_in_windows("dropoff_datetime", step, length)} AS "window", {_cell("se", "ss")} AS cell,
    fare_amount + tip_amount AS revenue
  FROM ig WHERE trip_time_in_secs <= 900),
drops AS (SELECT "window", cell, count(*) AS n FROM dwin GROUP BY ALL),
picks AS (SELECT window_end - INTERVAL '{length} minutes' AS "window", cell, count(*) AS n FROM pwin GROUP BY ALL),
empty AS (
  SELECT d."window", d.cell, d.n - coalesce(p.n, 0) AS empty_cabs
  FROM drops d LEFT JOIN picks p ON d."window" = p."window" AND d.cell = p.cell
  WHERE d.n > coalesce(p.n, 0)),
profit AS (
  SELECT "window", cell, quantile_disc(revenue, 0.5) AS profit FROM rwin GROUP BY ALL),
prof AS (
  SELECT e."window", e.cell, p.profit / e.empty_cabs AS profitability
  FROM empty e JOIN profit p ON e."window" = p."window" AND e.cell = p.cell)"""


# Sliding 30 minute windows every 15 minutes: two window ends per trip.
RC_SLIDING = f"""
rc AS (
  SELECT window_end, route, count(*) AS "count" FROM (
    SELECT {_bucket_end("dropoff_datetime", 15)} AS window_end, {ROUTE} AS route FROM ig
    UNION ALL
    SELECT {_bucket_end("dropoff_datetime", 15)} + INTERVAL '15 minutes', {ROUTE} FROM ig)
  GROUP BY ALL),"""


def _areas(k: int = 10, short: str = "trip_time_in_secs <= 900", intended: bool = False) -> str:
    return _with(TRIPS, _grid(intended), AREAS.format(k=k, short=short))


def _local_rank(src: str, key: str, item: str, value: str, k: int = 10) -> str:
    return f"""
SELECT {key}, {item}, {value}, CAST(local_rank AS INTEGER) AS local_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {value} DESC, {item}) AS local_rank FROM ({src}))
WHERE local_rank <= {k}"""


def _axis(expr: str) -> str:
    return f"CASE WHEN NOT ({expr} <= 300) THEN 999 ELSE {expr} END"


def _cell_or_outside(e: str, s: str) -> str:
    inside = f"({e} <= 300 AND {s} <= 300)"
    return f"CASE WHEN {inside} THEN {_cell(e, s)} WHEN NOT {inside} THEN '999.999' END"


_GRID_ALL = _with(TRIPS, _grid())

ORACLE_SQL = {
    # grid, projections, filters
    "cell_of_point": _GRID_ALL
    + f"""SELECT trip_id, {_cell_or_outside('se', 'ss')} AS cell_start,
         {_cell_or_outside('ee', 'es')} AS cell_end FROM grid""",
    "route_of_trip": _GRID_ALL
    + f"""SELECT trip_id, CASE WHEN (se <= 300 AND ss <= 300 AND ee <= 300 AND es <= 300) THEN {ROUTE}
         WHEN NOT (se <= 300 AND ss <= 300 AND ee <= 300 AND es <= 300) THEN '999.999->999.999' END AS route
       FROM grid""",
    "cell_axes": _GRID_ALL
    + f"""SELECT trip_id, {_axis('se')} AS pickup_east, {_axis('ss')} AS pickup_south,
         {_axis('ee')} AS dropoff_east, {_axis('es')} AS dropoff_south FROM grid""",
    "outlier_filter": _GRID_ALL
    + f"SELECT * EXCLUDE (se, ss, ee, es), {_cell('se', 'ss')} AS cell_start, {_cell('ee', 'es')} AS cell_end FROM ig",
    "short_trips": _with(TRIPS) + "SELECT * FROM trips WHERE trip_time_in_secs <= 900",
    "trip_revenue": _with(TRIPS) + "SELECT trip_id, fare_amount + tip_amount AS total_profit FROM trips",
    "window_bounds": BASE
    + """SELECT route, "count", window_end - INTERVAL '30 minutes' AS window_start, window_end FROM rc""",
    "frame_shape": _with(TRIPS) + "SELECT count(*) AS n_rows, 18 AS n_cols FROM trips",
    "sql_view_filter": BASE + """SELECT window_end, route, "count" FROM rc WHERE "count" = 5""",
    # frequent routes
    "route_counts": BASE + """SELECT window_end, route, "count" FROM rc""",
    "topk_routes": BASE[:-1] + "," + TOPK_ROUTES.format(k=10) + "\nSELECT * FROM topk",
    "window_trip_totals": BASE[:-1] + "," + TOTALS + "\nSELECT * FROM totals",
    "window_trip_totals_intended": BASE_INTENDED
    + """SELECT route, "count", total AS trips_per_window, window_end FROM (
      SELECT route, "count", window_end,
        CAST(sum("count") OVER (PARTITION BY window_end) AS BIGINT) AS total,
        row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, route) AS rn
      FROM rc) WHERE rn = 1""",
    "running_route_trips": BASE
    + """SELECT route, "count",
        CAST(sum("count") OVER (PARTITION BY window_end ORDER BY "count" DESC) AS BIGINT) AS running_trips,
        window_end
      FROM rc""",
    "rank_routes_with_ties": BASE
    + """SELECT route, "count", CAST(rk AS INTEGER) AS rank, window_end FROM (
        SELECT *, rank() OVER (PARTITION BY window_end ORDER BY "count" DESC) AS rk FROM rc)
      WHERE rk <= 10""",
    "frequent_routes_overall": BASE + "SELECT route, count(*) AS n_windows FROM rc GROUP BY route",
    "distinct_windows": BASE + "SELECT DISTINCT window_end FROM rc",
    "topk_routes_intended": BASE_INTENDED[:-1] + "," + TOPK_ROUTES.format(k=10) + "\nSELECT * FROM topk",
    # profitable areas
    "dropoff_counts": _areas() + "SELECT * FROM drops",
    "pickup_counts": _areas() + "SELECT * FROM picks",
    "empty_cabs": _areas() + "SELECT * FROM empty",
    "area_profit": _areas() + "SELECT * FROM profit",
    "profitability": _areas() + "SELECT * FROM prof",
    "topk_cells": _areas() + "SELECT * FROM topc",
    "topk_cells_k3": _areas(k=3) + "SELECT * FROM topc",
    "profitability_per_window": _areas()
    + 'SELECT "window", round(avg_profitability, 9) AS avg_profitability FROM perwin',
    "profitable_cells_intended": _with(TRIPS, _grid(True), _empty_intended(), _areas_intended())
    + "SELECT * FROM topc",
    "profitable_cells_sliding": _with(TRIPS, _grid(True), _empty_intended(5, 30), _areas_intended(10, 15, 5))
    + "SELECT * FROM topc",
    "empty_cabs_sliding": _with(TRIPS, _grid(), _areas_sliding()) + "SELECT * FROM empty",
    "profitability_sliding": _with(TRIPS, _grid(), _areas_sliding()) + "SELECT * FROM prof",
    "empty_taxis_intended": _with(TRIPS, _grid(True), _empty_intended()) + "SELECT * FROM empty",
    "topk_routes_sliding": _with(TRIPS, _grid(), RC_SLIDING) + TOPK_ROUTES.format(k=10) + "\nSELECT * FROM topk",
    # time-of-day profiles
    "route_daytime_profile": BASE[:-1]
    + ","
    + TOPK_ROUTES.format(k=10)
    + _local_rank(
        """SELECT strftime(window_end, '%H:%M') AS endtime, route, avg("count") AS avg_count
           FROM topk GROUP BY ALL""",
        "endtime",
        "route",
        "avg_count",
    ),
    "busiest_times": BASE[:-1]
    + ","
    + TOTALS
    + """SELECT strftime(window_end, '%H:%M') AS endtime, avg("count") AS avg_top_count FROM totals GROUP BY ALL""",
    "cell_daytime_profile": _areas()
    + _local_rank(
        """SELECT strftime("window", '%H:%M') AS time, cell, round(avg(profitability), 9) AS avg_profitability
           FROM topc GROUP BY ALL""",
        "time",
        "cell",
        "avg_profitability",
    ),
    "profitable_times": _areas()
    + """SELECT strftime("window", '%H:%M') AS time, round(avg(avg_profitability), 9) AS avg_profitability
      FROM perwin GROUP BY ALL""",
}


# Files of the file-based queries hold trip_id div ROWS_PER_FILE (sources/fixture.py).
_CHUNK = f"(trip_id // {ROWS_PER_FILE})"

_FARE_ONLY = FARE_SIDE[3:]


def _nth(columns: list[str]) -> str:
    rest = ", ".join(c for c in columns if c not in FARE_SIDE[:3])
    return f"row_number() OVER (PARTITION BY medallion, hack_license, pickup_datetime ORDER BY {rest})"


ORACLE_SQL.update(
    {
        # files
        "scan_trips_csv": _with(TRIPS) + "SELECT * EXCLUDE (trip_id) FROM trips",
        "scan_trips_parquet": _with(TRIPS)
        + "SELECT * EXCLUDE (trip_id), CAST(CAST(dropoff_datetime AS DATE) AS VARCHAR) AS dropoff_date FROM trips",
        "sink_csv_roundtrip": ORACLE_SQL["topk_routes"],
        "sink_single_csv": ORACLE_SQL["topk_routes"],
        "sink_per_window": ORACLE_SQL["topk_routes"],
        "merge_fare_trip": _with(TRIPS) + "SELECT * EXCLUDE (trip_id) FROM trips",
        # the n-th trip of a ride's keys, by its other columns, with the n-th fare by its own
        "merge_fare_trip_keys": _with(TRIPS)
        + f"""SELECT {", ".join(f"t.{c}" for c in TRIP_SIDE)}, {", ".join(f"f.{c}" for c in _FARE_ONLY)}
          FROM (SELECT *, {_nth(TRIP_SIDE)} AS nth FROM trips) t
          JOIN (SELECT *, {_nth(_FARE_ONLY)} AS nth FROM trips) f
            ON t.medallion = f.medallion AND t.hack_license = f.hack_license
              AND t.pickup_datetime = f.pickup_datetime AND t.nth = f.nth""",
        "scan_limit_per_file": _with(TRIPS)
        + f"""SELECT * EXCLUDE (trip_id, pos) FROM (
            SELECT *, row_number() OVER (PARTITION BY {_CHUNK} ORDER BY trip_id) AS pos FROM trips)
          WHERE pos <= {FILE_ROW_LIMIT}""",
        "positional_zip": _GRID_ALL
        + f"""SELECT CAST({_CHUNK} AS VARCHAR) AS file_key,
            row_number() OVER (PARTITION BY {_CHUNK} ORDER BY trip_id) - 1 AS row_pos,
            dropoff_datetime, {_axis('se')} AS pickup_east, {_axis('ss')} AS pickup_south,
            {_axis('ee')} AS dropoff_east, {_axis('es')} AS dropoff_south
          FROM grid""",
        "union_months": _with(TRIPS) + "SELECT * EXCLUDE (trip_id) FROM trips",
        "sorted_trips": _with(TRIPS) + "SELECT * FROM trips ORDER BY dropoff_datetime, trip_id",
        # streams equal the batch result
        "stream_route_counts_complete": ORACLE_SQL["route_counts"],
        "stream_route_counts_append": ORACLE_SQL["route_counts"],
        "stream_route_counts_update": ORACLE_SQL["route_counts"],
        "stream_route_counts_bytes": ORACLE_SQL["route_counts"],
        "stream_late_rows": ORACLE_SQL["route_counts"],
        "stream_clean_source": ORACLE_SQL["route_counts"],
        "stream_sorted_counts": ORACLE_SQL["route_counts"],
        "stream_topk_routes": ORACLE_SQL["topk_routes"],
        "stream_topk_routes_update": ORACLE_SQL["topk_routes"],
        "stream_memory_totals": BASE + 'SELECT window_end, CAST(sum("count") AS BIGINT) AS trips FROM rc GROUP BY window_end',
        # the earlier half comes after the later half, whose windows up to its last drop-off less 30 minutes are closed
        "stream_late_side_table": _with(TRIPS, _grid())
        + f"""SELECT window_end, route, count(*) AS "count" FROM (
            SELECT {_bucket_end("dropoff_datetime", 30)} AS window_end, {ROUTE} AS route,
              trip_id <= (SELECT max(trip_id) FROM trips) // 2 AS second,
              max(dropoff_datetime) OVER () AS latest
            FROM ig)
          WHERE second AND window_end <= latest - INTERVAL '30 minutes' GROUP BY ALL""",
        "stream_cell_pairs": _GRID_ALL
        + f"""SELECT dropoff_datetime, {_axis('se')} AS pickup_east, {_axis('ss')} AS pickup_south,
            {_axis('ee')} AS dropoff_east, {_axis('es')} AS dropoff_south FROM grid""",
        "stream_batch_counts": _with(TRIPS)
        + f"""SELECT count(*) AS num_rows, min(dropoff_datetime) AS first_time, max(dropoff_datetime) AS last_time
          FROM trips GROUP BY {_CHUNK}""",
    }
)

ORACLE_SQL["stream_positional_join"] = ORACLE_SQL["positional_zip"]
