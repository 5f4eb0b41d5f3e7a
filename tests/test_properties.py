"""Property layer: invariants of the route and area results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cabgrid.operators import areas, cells, routes
from cabgrid.plans import queries as Q


def test_route_counts_sum_to_in_grid_rows(trips_small):
    n = cells.in_grid_trips(trips_small).count()
    total = routes.route_counts(trips_small).agg(F.sum("count")).first()[0]
    assert total == n > 0


def test_ranks_are_dense_from_one_and_bounded(trips_small):
    for k in (1, 3, 10):
        top = Q.frequent_routes(trips_small, k)
        per = top.groupBy("window_end").agg(
            F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi")
        )
        assert per.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("n") > k)).count() == 0


def test_one_total_per_window_and_closed_form(trips_small):
    counts = routes.route_counts(trips_small)
    totals = routes.window_trip_totals(counts)
    n_windows = counts.select("window_end").distinct().count()
    assert totals.count() == totals.select("window_end").distinct().count() == n_windows
    # the kept row is rank 1 of the frequent-routes ranking
    top1 = routes.topk_routes(counts, 1).select("window_end", "route", "count")
    assert totals.select("window_end", "route", "count").exceptAll(top1).count() == 0
    # observed total = running sum at the kept row
    running = routes.running_route_trips(counts)
    joined = totals.join(running, ["window_end", "route", "count"])
    assert joined.where(F.col("trips_per_window") != F.col("running_trips")).count() == 0
    assert joined.count() == totals.count()


def test_intended_total_is_window_sum(trips_small):
    counts = routes.route_counts(trips_small)
    want = counts.groupBy("window_end").agg(F.sum("count").alias("s"))
    got = routes.window_trip_totals(counts, "intended").join(want, "window_end")
    assert got.where(F.col("s") != F.col("trips_per_window")).count() == 0


def test_ties_rank_covers_row_number(trips_small):
    counts = routes.route_counts(trips_small)
    ties = routes.rank_routes_with_ties(counts, 3).select("window_end", "route")
    top = routes.topk_routes(counts, 3).select("window_end", "route")
    assert top.exceptAll(ties).count() == 0


def test_fused_areas_equal_separate_aggregates(trips_small):
    drops = areas.dropoff_counts(trips_small)
    picks = areas.pickup_counts(trips_small)
    empty = (
        drops.join(picks, ["window", "cell"], "left")
        .na.fill(0, ["pickup_count"])
        .select("window", "cell", (F.col("dropoff_count") - F.col("pickup_count")).alias("empty_cabs"))
        .where(F.col("empty_cabs") > 0)
    )
    fused = areas.empty_cabs(trips_small)
    assert fused.exceptAll(empty).count() == 0 and empty.exceptAll(fused).count() == 0
    prof = (
        empty.join(areas.area_profit(trips_small), ["window", "cell"])
        .select("window", "cell", (F.col("profit") / F.col("empty_cabs")).alias("profitability"))
    )
    fused_prof = areas.profitability(trips_small)
    assert fused_prof.exceptAll(prof).count() == 0 and prof.exceptAll(fused_prof).count() == 0


@pytest.mark.parametrize("slide", ["5 minutes", "10 minutes", "15 minutes"])
def test_sliding_empty_cabs_equal_a_join_of_windows(trips_small, slide):
    t = cells.with_cells(cells.in_grid_trips(trips_small))
    drops = t.groupBy(F.window("dropoff_datetime", "15 minutes", slide).end.alias("window"), F.col("cell_end").alias("cell")).agg(F.count("*").alias("d"))
    picks = t.groupBy(F.window("pickup_datetime", "15 minutes", slide).start.alias("window"), F.col("cell_start").alias("cell")).agg(F.count("*").alias("p"))
    want = drops.join(picks, ["window", "cell"], "left").na.fill(0, ["p"]).selectExpr("window", "cell", "d - p AS empty_cabs").where("empty_cabs > 0")
    got = areas.empty_cabs(trips_small, slide=slide)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() > 0


def test_profitability_positive_and_topk_bounded(trips_small):
    top = Q.profitable_cells(trips_small, 3)
    assert top.where((F.col("rank") > 3) | (F.col("profitability") <= 0)).count() == 0


def test_profiles_sorted_by_time_then_rank(trips_small):
    from cabgrid.operators import profiles

    prof = profiles.route_daytime_profile(Q.frequent_routes(trips_small, 10), 10).collect()
    keys = [(r.endtime, r.local_rank) for r in prof]
    assert keys == sorted(keys) and len(keys) > 0
    busy = [r.endtime for r in profiles.busiest_times(Q.window_trip_totals(trips_small)).collect()]
    assert busy == sorted(busy)


def test_time_of_day_ignores_session_zone_gaps(spark):
    from cabgrid.functions.timewin import time_of_day

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS t, TIMESTAMP_NTZ '2024-11-03 01:30:00' AS u")
        got = df.select(time_of_day("t"), time_of_day("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("02:30", "01:30")


def test_utc_text_ignores_session_zone_gaps(spark):
    from cabgrid.functions.timewin import utc_text

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.25' AS t")
        got = df.select(utc_text("t")).first()[0]
        back = spark.createDataFrame([(got,)], "s string").selectExpr("CAST(s AS TIMESTAMP) AS i")
        wall = back.selectExpr("timestampadd(MICROSECOND, unix_micros(i), TIMESTAMP_NTZ '1970-01-01 00:00:00')").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2024-03-10T02:30:00.25Z"
    assert str(wall) == "2024-03-10 02:30:00.250000"


def test_results_do_not_depend_on_session_zone(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    keys = [
        "topk_routes",
        "topk_cells",
        "route_daytime_profile",
        "profitable_times",
        "scan_trips_csv",
        "sink_per_window",
    ]
    want = {k: sorted(E.queries()[k](spark, SF_SMALL).collect()) for k in keys}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {k: sorted(E.queries()[k](spark, SF_SMALL).collect()) for k in keys}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in keys:
        assert got[k] == want[k], k
