"""Queries of the catalogue on tables beyond those of the small scales, and on executors apart from the driver."""

import os
import subprocess
import sys
from pathlib import Path

from tidemark.operators.spec import ColumnSpec, TableSpec
from tidemark.plans import catalogue
from tidemark.sources import database
from tidemark.sources.config import Database

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
ON_A_CLUSTER = r"""
import os, sys
from decimal import Decimal
from pyspark.sql import SparkSession
from tidemark.plans import catalogue
from tidemark.sources import database
from tidemark.sources.config import Database

top = sys.argv[1]
conf = {"spark.executor.memory": "600m", "spark.checkpoint.dir": f"file://{top}/shared", "spark.sql.warehouse.dir": f"{top}/shared/warehouse", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC"}
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config(map=conf).getOrCreate()

about = database.options(Database("app", "shop", "TIDEMARK_PW", url="jdbc:derby:memory:cells;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver"))
connection = database.Connection(spark, Database("app", "shop", "TIDEMARK_PW", url=about["url"], driver=about["driver"]))
connection.execute('CREATE TABLE "t" ("k" BIGINT, "s" VARCHAR(20), "d" DECIMAL(10,2), "b" VARCHAR(20) FOR BIT DATA)')
texts = ["a", "", None, 'q"u"', ",", "new\nline", "cr\r\nlf", "back\\slash", "  blanks  ", "\u2603", "\t", "null", '"', "\n", " "]
rows = [(i, t, Decimal("1.50") if i % 3 else None, bytearray(b"\x00\xff") if i % 2 else bytearray() if i % 4 else None) for i, t in enumerate(texts)]
database.write_table(spark.createDataFrame(rows, "k long, s string, d decimal(10,2), b binary").select("b", "d", "s", "k"), "t", **about)
assert sorted(map(tuple, database.read_table(spark, table='"t"', **about).collect())) == rows
assert [r.s for r in database.read_query(spark, 'SELECT "s" FROM "t" WHERE "k" = 3', **about).collect()] == ['q"u"']

spark.range(10_500).selectExpr("id as c_custkey", "'c' || id as c_name", "case when id % 20 > 0 then cast(id as double) end as c_acctbal").write.parquet(f"{top}/customer.parquet")
found = {r.c_custkey: (r.c_name, r.c_acctbal) for r in catalogue.queries()["replicated_database"](spark, top).collect()}
assert found == {k: (f"c{k}", f"{k + (k % 10 == 0)}.00" if k % 20 else None) for k in range(10_500)}
print("all as it should be", flush=True)
os._exit(0)
"""


def test_products_beyond_64_bits_keep_their_low_bits(spark, tmp_path):
    """The SQL of the query has no result from key 15,873 on, as its own product overflows there; up to that both agree."""
    keys = [0, 499, 500, 501, 15_872, 15_873, 31_244, 31_245, 149_999, 8_999_999, 1 << 40]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = {r.o_orderkey: r.asDict() for r in catalogue.queries()["unsigned_from_log"](spark, str(tmp_path)).collect()}
    for k in keys:
        assert found[k]["u_bigint"] == str((k - 500) * 600_000_000_000_000 % (1 << 64))
        assert found[k]["u_int"] == (k * 777_777 - (1 << 31)) % (1 << 32)


def test_an_embedded_database_serves_executors_that_can_not_reach_it(tmp_path):
    """Cells of all kinds there and back, and a whole run with more changes than an event holds."""
    (tmp_path / "run.py").write_text(ON_A_CLUSTER)
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parent.parent), "TIDEMARK_PW": ""}
    done = subprocess.run([sys.executable, str(tmp_path / "run.py"), str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all as it should be" in done.stdout, done.stderr[-3000:]


def test_a_merge_looks_keys_up(spark, monkeypatch):
    """Without an index on the staging table, each row of the target is set against all of its rows."""
    monkeypatch.setenv("TIDEMARK_PW", "")
    found = Database("app", "shop", "TIDEMARK_PW", url="jdbc:derby:memory:lookup;create=true", driver=DERBY)
    connection = database.Connection(spark, found)
    connection.execute('CREATE TABLE "big" ("k" BIGINT PRIMARY KEY, "v" BIGINT)')
    target = database.DatabaseTarget(spark, found, TableSpec("t", "big", ("k",), (), (ColumnSpec("k"), ColumnSpec("v"))))
    said, execute = [], target.connection.execute
    monkeypatch.setattr(target.connection, "execute", lambda *statements: (said.extend(statements), execute(*statements)))
    ops = spark.range(2000).selectExpr("id as k", "id as v", "'u' as op", "cast(1 as long) as pos", "2 as seq")
    target.apply(ops)
    target.apply(ops.selectExpr("k", "v + 1 as v", "if(k % 2 = 0, 'd', 'u') as op", "pos + 1 as pos", "seq"))
    assert sorted(map(tuple, target.read().collect())) == [(k, k + 1) for k in range(1, 2000, 2)]
    index = [i for i, x in enumerate(said) if x.startswith("CREATE INDEX")]
    assert len(index) == 2 and all(said[i + 1].startswith("DELETE FROM") for i in index)
    target.close()
    connection.close()
