"""Plan shape: no hash shuffle of raw rows, in the static worst case.

With adaptive execution and automatic broadcasts off, every hash exchange of
every registered batch query must move rows that were combined somewhere
below it (a partial aggregate or a partial WindowGroupLimit), never input
rows as read. Range exchanges (global sorts) are exempt. The only queries
allowed to shuffle raw rows are the merges of trips and fares. They join two full
tables (in one shuffle where rides are matched by keys), and each scan joins a row per input split and a row per file, which
only adaptive execution, off here, can broadcast by their measured size.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from cabgrid import entrypoints as ep
from conftest import SF_SMALL

COMBINE = {"HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit"}
RAW_SHUFFLES_ALLOWED = {"merge_fare_trip_keys": 1, "merge_fare_trip": 4, "scan_limit_per_file": 4, "positional_zip": 10}
# Events of each taxi meet once, at most two copies of each whatever the slide (see the test of shuffled records).
RAW_SHUFFLES_ALLOWED |= {"empty_taxis_intended": 1, "profitable_cells_intended": 1, "profitable_cells_sliding": 1}
BATCH = sorted(k for k in ep.QUERIES if not k.startswith("stream_"))


def _children(node):
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _walk(node):
    yield node
    for c in _children(node):
        yield from _walk(c)


def _combined_below(exchange) -> bool:
    return any(node.nodeName() in COMBINE for node in _walk(exchange))


def raw_hash_shuffles(df) -> int:
    plan = df._jdf.queryExecution().executedPlan()
    n = 0
    for node in _walk(plan):
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.outputPartitioning().toString():
            n += not _combined_below(node)
    return n


@pytest.fixture
def static_plans(spark):
    keys = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", BATCH)
def test_no_raw_row_shuffle(spark, static_plans, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert raw_hash_shuffles(df) == RAW_SHUFFLES_ALLOWED.get(name, 0)


def test_walker_sees_a_raw_shuffle(spark, static_plans, trips_small):
    assert raw_hash_shuffles(trips_small.repartition("medallion")) == 1
    assert raw_hash_shuffles(trips_small.groupBy("medallion").count()) == 0


def test_file_positions_join_is_broadcast_by_measured_size(spark, trips_small):
    from cabgrid.session import scratch_path
    from cabgrid.sources.files import read_csv, with_file_position, write_csv

    path = scratch_path(spark, "pos-plan")
    write_csv(trips_small.select("trip_id"), path)
    df = with_file_position(read_csv(spark, path, schema=None))
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def _shuffled_records(df) -> int:
    """Rows that all hash exchanges of a plan run without adaptive execution wrote."""
    df.collect()
    n = 0
    for node in _walk(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.outputPartitioning().toString():
            n += node.metrics().get("shuffleRecordsWritten").get().value()
    return n


@pytest.mark.parametrize("name", ["empty_taxis_intended", "profitable_cells_intended", "profitable_cells_sliding", "topk_routes_sliding"])
def test_sliding_plans_shuffle_few_records_per_trip(spark, static_plans, name):
    from conftest import SF_ORACLE

    # An exact median takes a second shuffle, of the (window, cell, amount) counts, and nearly every amount here is
    # another one; every 5 minutes, a (window, cell) has so few trips that its aggregates combine little.
    bound = {"profitable_cells_intended": 5, "profitable_cells_sliding": 9}.get(name, 4)
    trips = spark.read.parquet(f"{SF_ORACLE}/events.parquet").count()
    assert _shuffled_records(E.queries()[name](spark, SF_ORACLE)) < bound * trips
