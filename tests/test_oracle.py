"""Oracle layer: every registered query equals its DuckDB SQL at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from cabgrid import entrypoints as ep
from compare import compare
from conftest import SF_ORACLE

SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, duck_oracle, name):
    ok, msg = compare(E.queries()[name](spark, SF_ORACLE), duck_oracle, SQL[name])
    assert ok, msg


def test_every_trip_query_has_oracle_sql():
    assert not set(ep.QUERIES) - set(SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["route", "count", "rank", "window_end"]
    assert df.count() > 0
