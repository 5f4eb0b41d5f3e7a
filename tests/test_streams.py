"""Stream layer: streams equal batch; arrival order decides watermark drops."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cabgrid.functions.timewin import utc_text, utc_wallclock
from cabgrid.operators import routes
from cabgrid.operators.cells import in_grid_trips
from cabgrid.plans import jobs
from cabgrid.plans.prepare import match_fares
from cabgrid.session import few_listing_tasks, scratch_path
from cabgrid.sources.schema import TRIP_COLUMNS
from cabgrid.streaming import columns, late, versions
from cabgrid.streaming import routes as S


def _write_chunks(trips, path, order):
    """Three trip_id ranges, appended to one folder in the given order (file times follow)."""
    cols = [utc_text(c).alias(c) if c.endswith("_datetime") else F.col(c) for c in TRIP_COLUMNS]
    bounds = [(0, 333), (333, 666), (666, 10**9)]
    for i in order:
        lo, hi = bounds[i]
        part = trips.where((F.col("trip_id") >= lo) & (F.col("trip_id") < hi))
        part.select(*cols).coalesce(1).write.mode("append").csv(path)


def _run_append(spark, src):
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    counts = S.stream_route_counts(S.read_trip_stream(spark, src, max_files_per_trigger=1), watermark="30 minutes")
    q = S.start(counts, "parquet", "append", ck, path=out)
    q.awaitTermination(600)
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", [])
    )
    q.stop()
    return S.read_window_output(spark, out), dropped


def _closed_batch(trips):
    counts = routes.route_counts(trips)
    last = in_grid_trips(trips).agg(F.max("dropoff_datetime")).first()[0]
    return counts.where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 30 MINUTES"))


def test_in_order_arrival_equals_batch(spark, trips_small):
    src = scratch_path(spark, "in-order")
    _write_chunks(trips_small, src, [0, 1, 2])
    got, dropped = _run_append(spark, src)
    want = _closed_batch(trips_small)
    assert dropped == 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_files_are_dropped_by_watermark(spark, trips_small):
    src = scratch_path(spark, "disorder")
    _write_chunks(trips_small, src, [2, 0, 1])
    got, dropped = _run_append(spark, src)
    assert dropped > 0
    # every emitted window is closed and no count exceeds the batch count
    want = _closed_batch(trips_small).withColumnRenamed("count", "want")
    joined = got.join(want, ["window_end", "route"], "left")
    assert joined.where(F.col("want").isNull() | (F.col("count") > F.col("want"))).count() == 0


def test_complete_mode_equals_batch_and_memory_sink(spark, trips_small):
    src = scratch_path(spark, "complete")
    _write_chunks(trips_small, src, [0, 1, 2])
    counts = S.stream_route_counts(S.read_trip_stream(spark, src))
    name = "t1_stream_test"
    q = S.start(counts, "memory", "complete", scratch_path(spark, "ck"), query_name=name)
    q.awaitTermination(600)
    q.stop()
    got = spark.table(name).withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    want = routes.route_counts(trips_small)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    five = spark.sql(f"SELECT * FROM {name} WHERE count = 5").count()
    assert five == want.where("count = 5").count()


def test_stream_result_independent_of_session_zone(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    want = E.queries()["stream_route_counts_append"](spark, SF_SMALL).collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")  # +05:45: not aligned to 30 minutes
    try:
        got = E.queries()["stream_route_counts_append"](spark, SF_SMALL).collect()
        batch = E.queries()["route_counts"](spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(got) == sorted(want) and len(got) > 0
    assert set(got) <= set(batch.collect())


def test_clean_source_archives_and_console_sink(spark, trips_small):
    src = scratch_path(spark, "retention")
    _write_chunks(trips_small, src, [0, 1, 2])
    archive = scratch_path(spark, "archive")
    stream = S.read_trip_stream(spark, src, max_files_per_trigger=1, clean_source="archive", archive_dir=archive)
    counts = S.ordered_counts(S.stream_route_counts(stream))
    q = S.start(counts, "console", "complete", scratch_path(spark, "ck"), numRows=3, truncate=False)
    q.awaitTermination(600)
    q.stop()
    assert len(q.recentProgress) >= 3
    moved = [f for _, _, files in os.walk(archive.removeprefix("file:")) for f in files if f.endswith(".csv")]
    assert moved, "processed files were not archived"


def test_restart_from_checkpoint_resumes_without_duplicates(spark, trips_small):
    src = scratch_path(spark, "resume-in")
    out, ck = scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ck")
    _write_chunks(trips_small, src, [0, 1])

    def run():
        stream = S.read_trip_stream(spark, src, max_files_per_trigger=1)
        q = S.start(S.stream_route_counts(stream, watermark="30 minutes"), "parquet", "append", ck, path=out)
        q.awaitTermination(600)
        q.stop()

    run()
    first = S.read_window_output(spark, out).count()
    _write_chunks(trips_small, src, [2])  # new data arrives after a stop
    run()  # same checkpoint: offsets, watermark and window state are restored
    got = S.read_window_output(spark, out)
    assert got.count() > first
    assert got.groupBy("window_end", "route").count().where("count > 1").count() == 0
    want = _closed_batch(trips_small)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_open_windows_complete_a_finite_input(spark, trips_small):
    src, out, ck = (scratch_path(spark, x) for x in ("ended", "ended-out", "ended-ck"))
    _write_chunks(trips_small, src, [0, 1, 2])
    rows = spark.read.csv(src).count()
    q = jobs.stream_routes_job(spark, src, out, ck, 10, "30 minutes", 1)
    q.awaitTermination()
    last = scratch_path(spark, "ended-open")
    S.write_open_windows(spark, ck, last, 10)
    want = routes.topk_routes(routes.route_counts(trips_small))
    closed, still_open = (S.read_window_output(spark, p).select(want.columns) for p in (out, last))
    assert S.dropped_rows(q) == 0 and closed.count() and still_open.count()
    assert _equal(closed.union(still_open), want)
    assert closed.join(still_open, "window_end").count() == 0
    assert spark.read.csv(src).count() == rows == trips_small.count()  # the input holds real trips only


def test_open_windows_change_nothing_in_the_checkpoint(spark, trips_small):
    src, out, ck = (scratch_path(spark, x) for x in ("again", "again-out", "again-ck"))

    def run():
        stream = S.read_trip_stream(spark, src, max_files_per_trigger=1)
        S.start(S.stream_route_counts(stream, watermark="30 minutes"), "parquet", "append", ck, path=out).awaitTermination()
        return S.read_window_output(spark, out).unionByName(S.open_windows(spark, ck))

    _write_chunks(trips_small, src, [0, 1])
    assert _equal(run(), routes.route_counts(trips_small.where("trip_id < 666")))
    _write_chunks(trips_small, src, [2])
    assert _equal(run(), routes.route_counts(trips_small))


@pytest.mark.parametrize("order", [[2, 0, 1], [2, 1, 0], [1, 2, 0], [0, 1, 2]])
def test_late_rows_are_kept_in_a_side_table(spark, trips_small, order):
    src, out, ck = (scratch_path(spark, x) for x in ("late", "late-out", "late-ck"))
    _write_chunks(trips_small, src, order)
    both = late.counts_and_arrivals(S.read_trip_stream(spark, src, max_files_per_trigger=1), "30 minutes")
    q = S.start(both, late.arrivals_writer(out), "append", ck)
    q.awaitTermination()
    side = late.late_counts(spark, out, "30 minutes")
    assert (side.count() > 0) == (S.dropped_rows(q) > 0) == (order != [0, 1, 2])
    assert _equal(late.merged_counts(spark, out, "30 minutes").unionByName(S.open_windows(spark, ck)), routes.route_counts(trips_small))


def test_job_without_watermark_keeps_late_rows(spark, trips_small):
    src, out = scratch_path(spark, "no-watermark"), scratch_path(spark, "no-watermark-out")
    _write_chunks(trips_small, src, [2, 0, 1])
    jobs.stream_routes_job(spark, src, out, scratch_path(spark, "ck"), 10, None, 1).awaitTermination()
    want = routes.topk_routes(routes.route_counts(trips_small))
    got = versions.read_latest(spark, f"{out}/ranking", versions.RANKING)
    assert _equal(got.withColumn("window_end", utc_wallclock("window_end")).select(want.columns), want)


def _files(path):
    root = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs}


def test_update_batches_rewrite_changed_days_only(spark):
    path = scratch_path(spark, "versions")
    write = versions.update_writer(path, k=1)
    at = "CAST('2024-01-0{} 10:00:00' AS TIMESTAMP)"
    batch = lambda *rows: spark.sql(
        " UNION ALL ".join(f"SELECT {at.format(d)} AS window_end, '{r}' AS route, {n}L AS count" for d, r, n in rows)
    )
    table = lambda: {(r["window_end"].day, r["route"]): r["count"] for r in versions.read_latest(spark, f"{path}/counts").collect()}
    write(batch((1, "a", 2), (1, "b", 1), (2, "a", 5)), 0)
    first = _files(path)
    write(batch((2, "a", 6), (2, "c", 9)), 1)
    assert table() == {(1, "a"): 2, (1, "b"): 1, (2, "a"): 6, (2, "c"): 9}
    assert first.items() <= _files(path).items()  # nothing written earlier was touched
    assert not any("day=2024-01-01" in f for f in set(_files(path)) - set(first))
    write(batch((2, "a", 6), (2, "c", 9)), 1)  # a replayed batch
    assert table() == {(1, "a"): 2, (1, "b"): 1, (2, "a"): 6, (2, "c"): 9}
    top = versions.read_latest(spark, f"{path}/ranking", versions.RANKING).collect()
    assert sorted((r["window_end"].day, r["route"], r["rank"]) for r in top) == [(1, "a", 1), (2, "c", 1)]
    assert [(r["batch_id"], r["day"].day) for r in versions.superseded(spark, f"{path}/counts").collect()] == [(0, 2)]


@pytest.mark.parametrize("k", [None, 2])
def test_update_batch_files_follow_days_and_tasks(spark, k):
    path = scratch_path(spark, "version-files")
    write = versions.update_writer(path, k)
    hours = spark.range(0, 40 * 24, 1, 8).selectExpr("timestamp_seconds(1704067200 + id * 3600) AS window_end", "id")
    rows = hours.selectExpr("window_end", "explode(array('a', 'b', 'c')) AS route", "id + 1 AS count")
    write(rows, 0)
    write(rows.withColumn("count", F.col("count") + 1), 1)
    tables = ["counts", "ranking"] if k else ["counts"]
    for t in tables:
        for b in (0, 1):  # 40 days and 8 tasks; up to 40 times 8 files when rows are dealt out by their hash
            assert 40 <= len([f for f in _files(f"{path}/{t}/batch_id={b}") if f.endswith(".parquet")]) <= 48
    want = rows.select("window_end", "route", (F.col("count") + 1).alias("count"))
    assert _equal(versions.read_latest(spark, f"{path}/counts"), want)
    if k:
        got = versions.read_latest(spark, f"{path}/ranking", versions.RANKING)
        assert _equal(got, routes.topk_routes(want, k).select(got.columns))


def test_many_files_of_a_micro_batch_are_counted_each(spark, trips_small, monkeypatch):
    from cabgrid import entrypoints as ep
    from cabgrid.sources import fixture

    queries = []
    started = S.start
    monkeypatch.setattr(S, "start", lambda *a, **k: queries.append(started(*a, **k)) or queries[-1])
    monkeypatch.setattr(ep, "_trips", lambda s, sf: trips_small)
    write = fixture.write_stream_files
    monkeypatch.setattr(fixture, "write_stream_files", lambda t, p, c: write(t, p, c, rows_per_file=100))
    got = ep.stream_batch_counts(spark, "")
    chunk = F.expr("trip_id div 100").alias("chunk")
    at = "dropoff_datetime"
    want = trips_small.groupBy(chunk).agg(F.count(F.lit(1)).alias("n"), F.min(at), F.max(at)).drop("chunk")
    assert got.count() == want.count() == 10 and _equal(got, want)
    assert len([p for p in queries[0].recentProgress if p["numInputRows"]]) == 1


def test_batches_by_bytes_keep_the_limit(spark, trips_small):
    src = scratch_path(spark, "bytes")
    sizes = [20, 300, 40, 500, 30]  # rows per file
    at = 0
    for n in sizes:
        part = trips_small.where((F.col("trip_id") >= at) & (F.col("trip_id") < at + n))
        part.select(*[utc_text(c).alias(c) if c.endswith("_datetime") else F.col(c) for c in TRIP_COLUMNS]).coalesce(1).write.mode("append").csv(src)
        at += n
    lengths = sorted(os.path.getsize(f) for f in _files(src) if f.endswith(".csv"))
    limit = lengths[-1] + lengths[0]  # the largest file has room for the smallest only
    stream = S.read_trip_stream(spark, src, max_bytes_per_trigger=limit)
    out = scratch_path(spark, "bytes-out")
    q = S.start(stream, columns.batch_counts_writer(out), "append", scratch_path(spark, "ck"))
    q.awaitTermination()
    batches = sorted(r["num_rows"] for r in spark.read.parquet(out).collect())
    assert batches == [30, 360, 500]  # in order of arrival: 20 + 300 + 40, 500, 30
    with pytest.raises(ValueError):
        S.read_trip_stream(spark, src, max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_column_streams_join_across_batches(spark):
    root, out, ck = (scratch_path(spark, x) for x in ("cols", "cols-out", "cols-ck"))
    ids = spark.range(0, 60, 1, 1).withColumn("chunk", F.expr("id div 20"))

    def put(name, where):
        text = ids.where(where).select("chunk", F.concat(F.lit(name), F.col("id").cast("string")).alias("value"))
        text.write.mode("append").partitionBy("chunk").text(f"{root}/{name}")

    def run():
        lines = {c: columns.read_column_lines(spark, f"{root}/{c}") for c in ("a", "b")}
        S.start(columns.join_column_streams(lines), "parquet", "append", ck, path=out).awaitTermination()
        return spark.read.parquet(out).collect()

    put("a", "chunk < 2")
    put("b", "chunk = 1 AND id < 35")
    assert sorted(r["a"] for r in run()) == [f"a{i}" for i in range(20, 35)]  # as far as both columns go
    put("b", "chunk <> 1")
    put("a", "chunk = 2")
    rows = run()
    assert len(rows) == 55 and all(r["a"][1:] == r["b"][1:] for r in rows)


def test_column_streams_keep_files_in_their_state_not_lines(spark):
    root, out, ck = (scratch_path(spark, x) for x in ("cols", "cols-out", "cols-ck"))
    texts = {"a": ["1", "2", "", "4"], "b": ["x", "", "z"], "c": ["p", "q", "r", "s", "t"]}
    for name, lines in texts.items():
        for chunk in range(3):
            rows = spark.createDataFrame([(chunk, f"{v}{chunk}" if v else "") for v in lines], "chunk int, value string").coalesce(1)
            rows.write.mode("append").partitionBy("chunk").text(f"{root}/{name}")
    lines = {c: columns.read_column_lines(spark, f"{root}/{c}") for c in texts}
    with few_listing_tasks(spark):
        assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) < 10000
        q = S.start(columns.join_column_streams(lines), "parquet", "append", ck, path=out)
        q.awaitTermination()
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None) is None
    got = spark.read.parquet(out).select("file_key", "row_pos", *texts).collect()
    want = [(f"{k}/0", 0, f"1{k}", f"x{k}", f"p{k}") for k in range(3)] + [(f"{k}/0", 1, f"2{k}", "", f"q{k}") for k in range(3)]
    want += [(f"{k}/0", 2, "", f"z{k}", f"r{k}") for k in range(3)]
    assert sorted(map(tuple, got)) == sorted(want)
    state = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert 0 < max(state) <= 6  # of two sides, three files each


def test_fares_match_trips_in_any_order(spark):
    at = "2013-01-01 00:00:0"
    trip = [("m1", "h", at + "1", "10"), ("m1", "h", at + "1", "20"), ("m2", "h", at + "2", "30"), (None, "h", at + "3", "40"), ("m9", "h", at + "9", "50")]
    fare = [("m2", "h", at + "2", "3.0"), ("m1", "h", at + "1", "2.0"), ("m1", "h", at + "1", "1.0"), (None, "h", at + "3", "4.0"), ("m8", "h", at + "8", "5.0")]
    trips = spark.createDataFrame(trip, "medallion string, hack_license string, pickup_datetime string, trip_time_in_secs string")
    fares = spark.createDataFrame(fare, "medallion string, hack_license string, pickup_datetime string, fare_amount string")
    for t, f in ((trips, fares), (trips.orderBy(F.desc("trip_time_in_secs")), fares.orderBy("fare_amount"))):
        got = match_fares(t, f).select("medallion", "trip_time_in_secs", "fare_amount").collect()
        want = [("m1", 10, 1.0), ("m1", 20, 2.0), ("m2", 30, 3.0), (None, 40, None), (None, None, 4.0), ("m9", 50, None), ("m8", None, 5.0)]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert match_fares(trips.limit(0), fares.limit(0)).count() == 0
