"""Every registered query next to its checking SQL, on the smallest data."""

import os

import duckdb
import pytest

from check import rows_of
from depscope.plans.registry import all_checks, all_queries
from depscope.plans.views import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_check():
    assert set(all_queries()) == set(all_checks())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, engine, name):
    df = all_queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = engine.execute(all_checks()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())
