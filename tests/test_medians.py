"""Exact grouped medians: large groups, ties, nulls and NaN, and no object aggregate in any plan."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cabgrid import entrypoints as ep
from cabgrid.operators import areas
from cabgrid.operators.medians import median_of_counts
from conftest import SF_SMALL


def _medians(rows):
    counts = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    return {r["k"]: r["median"] for r in median_of_counts(counts, ["k"], "v", "n").collect()}


def test_large_groups_equal_the_discrete_quantile(spark):
    # 60,000 distinct values in one group, and groups of odd, even and single size with ties
    big = spark.range(60_000).selectExpr("0 AS k", "CAST(xxhash64(id) AS DOUBLE) / 1e6 AS v")
    small = spark.range(5_000).selectExpr("1 + id % 41 AS k", "CAST((id * 7919) % 23 AS DOUBLE) / 4 AS v")
    rows = big.union(small).union(spark.range(1).selectExpr("99 AS k", "5.5D AS v"))
    pdf = rows.toPandas()
    want = dict(duckdb.sql("SELECT k, quantile_disc(v, 0.5) FROM pdf GROUP BY k").fetchall())
    assert len(pdf) == 65_001 and _medians(rows) == want


def test_nulls_do_not_count_and_nan_is_largest(spark):
    rows = [(1, None), (1, None), (1, 3.0), (1, 1.0), (2, None), (3, float("nan")), (3, 1.0), (3, 2.0), (4, 0.0), (4, -0.0)]
    assert _medians(spark.createDataFrame(rows, "k int, v double")) == {1: 1.0, 2: None, 3: 2.0, 4: 0.0}


def test_busy_cell_keeps_an_exact_median(trips_small):
    # all trips end in one window and start in one cell: far more amounts than the sketch of the original keeps apart
    many = trips_small.where("pickup_latitude BETWEEN 40.0 AND 41.0 AND pickup_longitude < -73.9")
    one = many.limit(1).drop("fare_amount", "tip_amount", "trip_time_in_secs")
    busy = one.crossJoin(trips_small.sparkSession.range(30_001).selectExpr("id + 0.25D AS fare_amount", "0.5D AS tip_amount", "60 AS trip_time_in_secs"))
    assert [r["profit"] for r in areas.area_profit(busy).collect()] == [15_000.75]
    assert [r["profit"] for r in areas.area_stats(busy).where("n_profit > 0").collect()] == [15_000.75]


@pytest.mark.parametrize("name", sorted(k for k in ep.QUERIES if not k.startswith("stream_")))
def test_no_object_aggregates(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan
