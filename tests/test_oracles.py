"""Every registered query with a DuckDB twin must match it at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bandwise.sources.tables import TABLES
from tests.conftest import SMOKE
from tools.oracle_check import value_hash

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SMOKE, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SMOKE).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert value_hash(got) == value_hash(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "coverage" in df.columns
