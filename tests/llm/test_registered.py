from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from daybridge.llm import queries as Q
from tests.llm.helpers import SF


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    want = con.sql(Q.oracle_sql()[name])
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
