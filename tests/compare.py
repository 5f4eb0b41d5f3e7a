"""Spark result against DuckDB oracle: column names, row count, exact row multiset.

    python tests/compare.py [SF_DIR] [KEY...]             compare with the oracle
    python tests/compare.py --explain [SF_DIR] KEY...     print formatted physical plans
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows(df: pd.DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    df = df[cols].astype(object)
    return cols, Counter(tuple(_norm(v) for v in r) for r in df.itertuples(index=False, name=None))


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    sc, sr = rows(s)
    dc, dr = rows(d)
    if sc != dc:
        return False, f"columns differ: spark={sc} oracle={dc}"
    if len(s) != len(d):
        return False, f"row count spark={len(s)} oracle={len(d)}"
    if sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        return False, f"{sum((sr - dr).values())} rows differ; spark-only {only_s} oracle-only {only_d}"
    return True, f"{len(s)} rows equal"


if __name__ == "__main__":
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    args = sys.argv[1:]
    explain = "--explain" in args
    args = [a for a in args if a != "--explain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    if explain:  # python tests/compare.py --explain SF_DIR KEY...: formatted physical plans only
        for name in sorted(only or qs):
            print(f"===== {name}")
            qs[name](spark, sf).explain("formatted")
        sys.exit(0)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            n = fn(spark, sf).count()
            print(f"{name:32s} NO-ORACLE rows={n} {time.time() - t:.1f}s", flush=True)
            continue
        try:
            ok, msg = compare(fn(spark, sf), con, sqls[name])
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} {time.time() - t:.1f}s", flush=True)
    print("mismatches:", bad)
