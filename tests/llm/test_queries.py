import os
import re

import duckdb
import pytest

import __spark_entry__
from tidemark.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(repr, want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()))


def test_all_are_registered():
    names = list(__spark_entry__.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11)) and "pipeline" in names
