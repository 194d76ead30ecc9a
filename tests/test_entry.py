"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not present")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "diff_next" in df.columns


def test_every_query_has_an_oracle():
    assert set(entry._own_queries()) == set(entry._own_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._own_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(entry.oracle_sql()[name])
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, got) == _rows(res.columns, exp)
