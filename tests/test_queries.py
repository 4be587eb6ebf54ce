"""Every query of the catalogue against its SQL in DuckDB."""

import os

import duckdb
import pytest

from tidemark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    want = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert got == sorted(map(repr, want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
