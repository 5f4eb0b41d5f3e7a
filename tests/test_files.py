"""Files: row positions across blocks, sinks, preparation."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cabgrid.plans.prepare import prepare_trips
from cabgrid.session import scratch_path
from cabgrid.sources import files, fixture
from cabgrid.sources.files import first_rows_per_file, join_parts, read_csv, with_file_position, write_csv
from cabgrid.sources.schema import TRIP_COLUMNS


@pytest.fixture
def many_parts(spark):
    """Small shuffle partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _local(path: str) -> str:
    """Local file system path of a ``file:`` URI (tests list part files directly)."""
    return path.removeprefix("file:")


def test_positions_survive_file_splits(spark, trips_small):
    path = scratch_path(spark, "split-test")
    trips_small.select("trip_id", *TRIP_COLUMNS).coalesce(1).sortWithinPartitions("trip_id").write.csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024))
    try:
        scan = spark.read.schema("trip_id long").csv(path)
        assert scan.rdd.getNumPartitions() > 4  # one file, many blocks
        pos = with_file_position(scan)
        bad = pos.where(F.col("row_pos") != F.col("trip_id"))
        assert pos.count() == trips_small.count()
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sorted_parts_concatenate_in_order(spark, trips_small):
    path = scratch_path(spark, "sorted-parts")
    # several parts even on tiny data: no adaptive coalescing here
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        write_csv(trips_small.select("trip_id", "dropoff_datetime"), path, order_by=["dropoff_datetime", "trip_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in os.listdir(_local(path)) if p.startswith("part-"))
    assert len(parts) > 1
    ids = []
    for p in parts:
        with open(os.path.join(_local(path), p)) as fh:
            ids += [int(line.split(",")[0]) for line in fh if line.strip()]
    want = [r.trip_id for r in trips_small.orderBy("dropoff_datetime", "trip_id").select("trip_id").collect()]
    assert ids == want


def test_parts_join_to_one_file_in_part_order(spark, trips_small, many_parts):
    path = scratch_path(spark, "parts")
    write_csv(trips_small.select("dropoff_datetime", "trip_id").repartition(5), path, order_by=["dropoff_datetime", "trip_id"])
    parts = sorted(p for p in os.listdir(_local(path)) if p.startswith("part-"))
    lines = [line for p in parts for line in open(os.path.join(_local(path), p))]
    target = join_parts(spark, path, f"{path}.csv")
    assert len(parts) > 1 and open(_local(target)).read() == "".join(lines) and len(lines) == trips_small.count()
    with pytest.raises(FileExistsError):
        join_parts(spark, path, target)
    with pytest.raises(ValueError, match="bytes"):  # the bound is checked before a byte is copied
        join_parts(spark, path, f"{path}-2.csv", copy_at_most=10)
    assert not os.path.exists(_local(f"{path}-2.csv"))


def test_sink_fails_when_present(spark, trips_small):
    path = scratch_path(spark, "present")
    df = trips_small.select("trip_id").limit(5)
    write_csv(df, path)
    try:
        write_csv(df, path)
        raise AssertionError("second write should fail")
    except Exception as exc:  # noqa: BLE001
        assert "already exists" in str(exc).lower() or "PATH_ALREADY_EXISTS" in str(exc)


def test_fare_headers_blanks_stripped_and_trip_wins(spark, trips_small):
    trip_dir, fare_dir = scratch_path(spark, "t"), scratch_path(spark, "f")
    fixture.write_trip_fare_files(trips_small, trip_dir, fare_dir)
    raw = spark.read.option("header", True).csv(fare_dir)
    assert " hack_license" in raw.columns
    merged = prepare_trips(spark, trip_dir, fare_dir, pair_on="chunk")
    assert merged.columns == TRIP_COLUMNS
    want = trips_small.select(*TRIP_COLUMNS)
    assert merged.exceptAll(want).count() == 0 and want.exceptAll(merged).count() == 0
    limited = prepare_trips(spark, trip_dir, fare_dir, rows_per_file=100, pair_on="chunk")
    files = trips_small.select(F.expr(f"trip_id div {fixture.ROWS_PER_FILE}")).distinct().count()
    assert limited.count() == 100 * files


def test_pairing_by_file_name_digits(spark, trips_small):
    root = scratch_path(spark, "named")
    t = trips_small.select(*TRIP_COLUMNS)
    for k in (1, 2):
        part = t.where(F.hour("dropoff_datetime") % 2 == k - 1)
        write_csv(part.select(*fixture.TRIP_SIDE).coalesce(1), f"{root}/trip_data_{k}.csv", header=True)
        fare = part.select(*[F.col(c).alias(c if i == 0 else f" {c}") for i, c in enumerate(fixture.FARE_SIDE)])
        write_csv(fare.coalesce(1), f"{root}/trip_fare_{k}.csv", header=True, ignoreLeadingWhiteSpace=False)
    merged = prepare_trips(spark, f"{root}/trip_data_*.csv", f"{root}/trip_fare_*.csv")
    assert merged.count() == t.count()
    assert merged.where(F.col("payment_type").isNull()).count() == 0


def test_scan_glob_reads_declared_types(spark, trips_small):
    path = scratch_path(spark, "glob")
    write_csv(trips_small.select(*TRIP_COLUMNS), path)
    back = read_csv(spark, f"{path}/*.csv")
    assert dict(back.dtypes)["trip_time_in_secs"] == "int"
    assert dict(back.dtypes)["dropoff_datetime"] == "timestamp_ntz"
    assert back.exceptAll(trips_small.select(*TRIP_COLUMNS)).count() == 0


def test_per_window_sink_keeps_files_few_and_windows_readable(spark, trips_small):
    from cabgrid.plans import queries as Q
    from cabgrid.sources.files import read_per_window, write_per_window
    from cabgrid.sources.schema import RANKING_SCHEMA

    path = scratch_path(spark, "per-window-layout")
    ranked = Q.frequent_routes(trips_small)
    write_per_window(ranked, path)
    windows = [r[0] for r in ranked.select("window_end").distinct().collect()]
    files = [f for _, _, fs in os.walk(_local(path)) for f in fs if f.endswith(".csv")]
    assert 0 < len(files) < len(windows)
    assert {p for p in os.listdir(_local(path)) if "=" in p} == {f"day={w.date()}" for w in windows}
    one = read_per_window(spark, path, RANKING_SCHEMA, window=windows[0])
    want = ranked.where(F.col("window_end") == F.lit(windows[0])).select(*one.columns)
    assert sorted(one.collect()) == sorted(want.collect()) and one.count() > 0
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_missing_dropoff_times_are_spread_over_ranges(spark, trips_small, many_parts):
    from cabgrid.sources.files import write_trips_parquet

    path = scratch_path(spark, "null-times")
    gaps = trips_small.withColumn("dropoff_datetime", F.when(F.col("trip_id") % 3 == 0, F.col("dropoff_datetime")))
    write_trips_parquet(gaps, path)
    folder = os.path.join(_local(path), "dropoff_date=__HIVE_DEFAULT_PARTITION__")
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1


def test_shape_of_a_parquet_table_reads_no_column(spark):
    from cabgrid.entrypoints import frame_shape
    from conftest import SF_SMALL

    assert "ReadSchema: struct<>" in frame_shape(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_first_rows_alone_are_written(spark, monkeypatch):
    path, folders = scratch_path(spark, "large"), []
    monkeypatch.setattr(files, "scratch_path", lambda s, name: folders.append(scratch_path(s, name)) or folders[-1])
    rows = spark.range(0, 100_000, 1, 2).select(F.col("id").cast("string").alias("id"))
    rows.withColumn("chunk", F.spark_partition_id()).write.partitionBy("chunk").option("header", True).csv(path)
    got = first_rows_per_file(spark, path, 50, header=True).collect()
    assert sorted((int(r["id"]), r["row_pos"]) for r in got) == [(50_000 * c + i, i) for c in (0, 1) for i in range(50)]
    assert [spark.read.parquet(f).count() for f in folders] == [100]


@pytest.mark.parametrize("n", [1, 7, 30, 100])
def test_first_rows_go_on_to_later_parts(spark, n, many_parts):
    root = scratch_path(spark, "short-parts")
    for k in (1, 2):  # a folder of 7 + 7 + 6 rows, and one of 20
        spark.range(100 * k, 100 * k + 20, 1, 3 if k == 1 else 1).select(F.col("id").alias("v")).write.option("header", True).csv(f"{root}/f_{k}.csv")
    got = first_rows_per_file(spark, f"{root}/*", n, header=True).collect()
    want = [(100 * k + i, i) for k in (1, 2) for i in range(min(n, 20))]
    assert sorted((int(r["v"]), r["row_pos"]) for r in got) == want


@pytest.mark.parametrize("small", [1 << 22, 700])
def test_first_rows_of_many_small_files_take_few_tasks(spark, monkeypatch, small):
    path, folders = scratch_path(spark, "many-small"), []
    monkeypatch.setattr(files, "scratch_path", lambda s, name: folders.append(scratch_path(s, name)) or folders[-1])
    monkeypatch.setattr(files, "SMALL_FILE", small)  # 700 bytes: files of 100 rows are small, those of 300 are not
    rows = spark.range(0, 60 * 100, 1, 4).withColumn("chunk", F.expr("id div 100"))
    rows = rows.unionByName(spark.range(10_000, 10_600).withColumn("chunk", F.expr("100 + (id - 10000) div 300")))
    text = rows.select("chunk", F.col("id").cast("string").alias("id"))
    text.repartition(8, "chunk").sortWithinPartitions("chunk", "id").write.partitionBy("chunk").option("header", True).csv(path)
    got = first_rows_per_file(spark, path, 50, header=True)
    assert got.groupBy("chunk").count().where("count = 50").count() == got.count() // 50 == 62
    first = rows.selectExpr("chunk", "CAST(id AS string) AS id", "row_number() OVER (PARTITION BY chunk ORDER BY CAST(id AS string)) AS nth")
    assert sorted((r["chunk"], r["id"]) for r in got.collect()) == sorted((r["chunk"], r["id"]) for r in first.where("nth <= 50").collect())
    written = [f for f in os.listdir(_local(folders[0])) if f.endswith(".parquet")]
    cores = spark.sparkContext.defaultParallelism
    assert len(written) <= cores + 4  # a task and a file for each of the 62 files before
