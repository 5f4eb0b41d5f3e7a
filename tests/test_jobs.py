"""Job lifecycle: CSV in, both outputs written from one checkpointed intermediate."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.__main__ import main
from cabgrid.operators import areas, routes
from cabgrid.plans import jobs
from cabgrid.plans.jobs import OUTPUT_TS_FORMAT
from cabgrid.plans import queries as Q
from cabgrid.session import scratch_path
from cabgrid.sources.files import read_csv, write_csv
from cabgrid.sources.schema import RANKING_SCHEMA, TRIP_COLUMNS

TOTALS_SCHEMA = "route string, count long, trips_per_window long, window_end timestamp_ntz"
PROF_SCHEMA = "window timestamp_ntz, cell string, profitability double, rank int"
PER_WINDOW_SCHEMA = "window timestamp_ntz, avg_profitability double"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _trip_files(spark, trips):
    path = scratch_path(spark, "job-in")
    write_csv(trips.select(*TRIP_COLUMNS), path)
    return f"{path}/*.csv"


def test_frequent_routes_job(spark, trips_small):
    out = jobs.frequent_routes_job(spark, _trip_files(spark, trips_small), scratch_path(spark, "job-out"))
    fmt = {"timestampNTZFormat": OUTPUT_TS_FORMAT}
    ranked = read_csv(spark, out["rankings"], RANKING_SCHEMA, **fmt)
    totals = read_csv(spark, out["window_counts"], T._parse_datatype_string(TOTALS_SCHEMA), **fmt)
    lines = [r[0] for r in spark.read.text(out["window_counts"]).collect()]
    assert all(x.endswith(".000Z") and x.count(",") == 3 for x in lines)
    assert _same(ranked, Q.frequent_routes(trips_small))
    assert _same(totals, Q.window_trip_totals(trips_small))


def test_profitable_areas_job_via_cli(spark, trips_small):
    out_dir = scratch_path(spark, "job-out")
    main(["profitable-areas", _trip_files(spark, trips_small), out_dir, "--k", "3"])
    fmt = {"timestampNTZFormat": OUTPUT_TS_FORMAT}
    top = read_csv(spark, f"{out_dir}/profitability", T._parse_datatype_string(PROF_SCHEMA), **fmt)
    per = read_csv(spark, f"{out_dir}/profitability_per_window", T._parse_datatype_string(PER_WINDOW_SCHEMA), **fmt)
    assert _same(top, Q.profitable_cells(trips_small, 3))
    want = areas.profitability_per_window(areas.profitability(trips_small))
    r = lambda df: df.select("window", F.round("avg_profitability", 9).alias("a"))
    assert _same(r(per), r(want))


def test_sliding_jobs_via_cli(spark, trips_small):
    fmt, files = {"timestampNTZFormat": OUTPUT_TS_FORMAT}, _trip_files(spark, trips_small)
    out = scratch_path(spark, "job-out")
    main(["profitable-areas", files, f"{out}/q2", "--slide", "5 minutes"])
    top = read_csv(spark, f"{out}/q2/profitability", T._parse_datatype_string(PROF_SCHEMA), **fmt)
    assert _same(top, Q.profitable_cells(trips_small, slide="5 minutes"))
    main(["frequent-routes", files, f"{out}/q1", "--slide", "15 minutes"])
    assert _same(read_csv(spark, f"{out}/q1/rankings", RANKING_SCHEMA, **fmt), Q.frequent_routes(trips_small, slide="15 minutes"))
    totals = read_csv(spark, f"{out}/q1/window_counts", T._parse_datatype_string(TOTALS_SCHEMA), **fmt)
    assert _same(totals, Q.window_trip_totals(trips_small, slide="15 minutes"))


def test_stream_routes_job(spark, trips_small):
    from cabgrid.sources import fixture

    src = scratch_path(spark, "job-stream-in")
    fixture.write_stream_files(trips_small, src)
    out = scratch_path(spark, "job-stream-out")
    q = jobs.stream_routes_job(spark, src, out, scratch_path(spark, "job-stream-ck"))
    q.awaitTermination(600)
    q.stop()
    got = spark.read.parquet(out).count()
    counts = routes.route_counts(trips_small)
    assert 0 < got <= routes.topk_routes(counts).count()


def test_parquet_store_prunes_columns_and_pushes_the_bounding_box(spark, trips_small):
    from cabgrid.sources.files import read_trips, write_trips_parquet

    path = scratch_path(spark, "store")
    write_trips_parquet(trips_small.select(*TRIP_COLUMNS), path)
    top = Q.frequent_routes(read_trips(spark, path, "parquet"))
    plan = top._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PushedFilters: [" in scan and "pickup_latitude" in scan.split("PushedFilters: [", 1)[1]
    read_schema = scan.split("ReadSchema: struct<", 1)[1]
    assert "fare_amount" not in read_schema and "medallion" not in read_schema  # 5 of 17 columns read
    assert _same(top, Q.frequent_routes(trips_small))
    out = jobs.frequent_routes_job(spark, path, scratch_path(spark, "job-out"), input_format="parquet")
    fmt = {"timestampNTZFormat": OUTPUT_TS_FORMAT}
    assert _same(read_csv(spark, out["rankings"], RANKING_SCHEMA, **fmt), Q.frequent_routes(trips_small))


def test_prepare_job_via_cli_to_parquet_store_and_csv(spark, trips_small):
    from cabgrid.sources import fixture
    from cabgrid.sources.files import read_trips

    trip_dir, fare_dir = scratch_path(spark, "prep-trip"), scratch_path(spark, "prep-fare")
    fixture.write_trip_fare_files(trips_small, trip_dir, fare_dir)
    want = trips_small.select(*TRIP_COLUMNS)

    store = scratch_path(spark, "prep-store")
    main(["prepare", trip_dir, fare_dir, store, "--output-format", "parquet"])
    got = read_trips(spark, store, "parquet").select(*TRIP_COLUMNS)
    assert _same(got, want)

    out = scratch_path(spark, "prep-csv")
    jobs.prepare_job(spark, trip_dir, fare_dir, out, rows_per_file=100)
    back = read_csv(spark, out)
    files = trips_small.select(F.expr(f"trip_id div {fixture.ROWS_PER_FILE}")).distinct().count()
    assert back.count() == 100 * files
    import os

    local = out.removeprefix("file:")
    times = []
    for part in sorted(p for p in os.listdir(local) if p.startswith("part-")):  # concatenated in name order
        with open(os.path.join(local, part)) as fh:
            times += [line.split(",")[3] for line in fh if line.strip()]
    assert len(times) == back.count() and times == sorted(times)


def test_stream_and_profile_via_cli(spark, trips_small, monkeypatch):
    from cabgrid.sources import fixture
    from cabgrid.streaming import routes as sroutes

    src, out = scratch_path(spark, "cli-stream-in"), scratch_path(spark, "cli-stream-out")
    fixture.write_stream_files(trips_small, src)
    ck, still_open = scratch_path(spark, "cli-stream-ck"), scratch_path(spark, "cli-stream-open")
    main(["stream-routes", src, out, ck])
    main(["stream-open", ck, still_open])
    want = Q.frequent_routes(trips_small)
    both = [sroutes.read_window_output(spark, p).select(want.columns) for p in (out, still_open)]
    assert all(b.count() for b in both) and _same(both[0].union(both[1]), want)
    profile = scratch_path(spark, "cli-profile")
    main(["daytime-profile", _trip_files(spark, trips_small), profile])
    schema = T._parse_datatype_string("endtime string, route string, avg_count double, local_rank int")
    assert _same(read_csv(spark, profile, schema), Q.daytime_profile(trips_small))
    seen = []
    monkeypatch.setattr(jobs, "stream_routes_job", lambda *a: seen.append(a[5]) or sroutes.start)
    for flag in ([], ["--no-watermark"], ["--watermark", "2 hours"]):
        try:
            main(["stream-routes", src, out, "ck", *flag])
        except AttributeError:  # the stand-in is no query
            pass
    assert seen == ["30 minutes", None, "2 hours"]
