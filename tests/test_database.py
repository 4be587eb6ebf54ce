import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tidemark.streaming.run as run
from tidemark.operators import keys, snapshot
from tidemark.operators.spec import REQUIRED_SETTINGS, ColumnSpec, SpecError, TableSpec
from tidemark.sources import change_log, database
from tidemark.sources.config import Database, State, parse_config

URL, DRIVER = "jdbc:derby:memory:tidemark;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
GOOD = "select " + ", ".join(f"'{v}' as {n}" for n, v in REQUIRED_SETTINGS.items()) + " from SYSIBM.SYSDUMMY1"
COLUMNS = [("k", "bigint", "bigint"), ("name", "varchar", "varchar(20)"), ("price", "decimal", "decimal(10,2)"), ("size", "enum", "enum('s','l')"), ("secret", "varchar", "varchar(9)")]


@pytest.fixture(scope="module")
def db(spark):
    with pytest.MonkeyPatch.context() as patch:
        patch.setenv("DERBY_PW", "")
        found = Database("app", "shop", "DERBY_PW", url=URL, driver=DRIVER, settings_query=GOOD)
        try:
            connection = database.Connection(spark, found)
        except Exception as e:  # the embedded database is not part of every distribution
            pytest.skip(str(e)[:200])
        kinds = "VARCHAR(20)", "BIGINT", "DECIMAL(10,2)"
        connection.execute(
            'CREATE TABLE "users" ("k" BIGINT PRIMARY KEY, "name" VARCHAR(20), "price" DECIMAL(10,2), "size" VARCHAR(3), "secret" VARCHAR(9))',
            'CREATE TABLE "copy" ("k" BIGINT PRIMARY KEY, "name" VARCHAR(20), "price" DECIMAL(10,2), "size" VARCHAR(3))',
            'CREATE TABLE "marks" ("id" VARCHAR(32))',
            f"CREATE TABLE INFORMATION_SCHEMA.COLUMNS (TABLE_SCHEMA {kinds[0]}, TABLE_NAME {kinds[0]}, COLUMN_NAME {kinds[0]}, DATA_TYPE {kinds[0]}, CHARACTER_SET_NAME {kinds[0]}, IS_NULLABLE {kinds[0]}, COLUMN_TYPE {kinds[0]}, ORDINAL_POSITION {kinds[1]})",
            *(f"INSERT INTO INFORMATION_SCHEMA.COLUMNS VALUES ('shop', 'users', '{n}', '{t}', NULL, '{'NO' if n == 'k' else 'YES'}', {database.literal(c)}, {i})" for i, (n, t, c) in enumerate(COLUMNS)),
        )
        yield found, connection
        connection.close()


class Producer:
    """Changes the table as time goes on, and writes the log of it: marks first, as they are there already."""

    def __init__(self, connection, folder, seed=1):
        self.connection, self.folder, self.rng, self.pos, self.state, self.marks, self.quiet, self.ticks = connection, folder, random.Random(seed), 0, {}, set(), False, 0
        folder.mkdir()

    def log(self, *events):
        lines = []
        for e in events:
            self.pos += 1
            lines.append(json.dumps({"pos": self.pos, "db": "shop", "is_commit": True} | e))
        if lines:
            (self.folder / f"{self.pos - len(lines) + 1:012d}.jsonl").write_text("\n".join(lines))

    def row(self, k):
        return None if k not in self.state else dict(zip(("k", "name", "price", "size", "secret"), (k, *self.state[k], "x"), strict=True))

    def change(self, n):
        for _ in range(n):
            k = self.rng.randrange(30)
            before = self.row(k)
            self.connection.execute(f'DELETE FROM "users" WHERE "k" = {k}')
            self.state.pop(k, None)
            if before is None or self.rng.random() < 0.6:
                name, price, size = f"n{self.pos}'", f"{self.rng.randrange(999)}.50", self.rng.randint(1, 2)
                self.connection.execute(f'INSERT INTO "users" VALUES ({k}, {database.literal(name)}, {price}, \'{" sl"[size]}\', \'x\')')
                self.state[k] = (name, price, size)
            if before or k in self.state:
                self.log({"tbl": "users", "kind": "update", "changes": [{"before": before, "after": self.row(k)}]})

    def pump(self, seconds):
        self.ticks += seconds
        if self.quiet:
            return
        for r in database.read_table(self.spark, table='"marks"', **self.options).collect():
            if r[0] not in self.marks:
                self.marks.add(r[0])
                self.log({"tbl": "marks", "kind": "mark", "mark_id": r[0]})
        self.change(3)


def test_a_live_database_is_copied_while_it_changes(spark, db, tmp_path):
    """Marks between changes, chunks by key, a conversion, a stop, a silent log, and the log to the end."""
    found, connection = db
    producer = Producer(connection, tmp_path / "log")
    producer.spark, producer.options = spark, database.options(found)
    producer.change(40)
    entry = {"user": "app", "db": "shop", "password_env": "DERBY_PW", "url": URL, "driver": DRIVER, "settings_query": GOOD}
    config = parse_config({"mysql": entry, "postgres": entry, "chunk_size": 4, "watermark_table": "marks", "watermark_timeout_seconds": 4, "tables": [{"mysql_table": "users", "pg_table": "copy", "key_columns": ["k"], "skip_columns": ["secret"]}]})

    def go(stop=lambda: False):
        return run.replicate(spark, str(tmp_path), config, stop, once=True, source=run.DatabaseSource(spark, str(tmp_path), config, sleep=producer.pump, clock=lambda: producer.ticks))

    asked = iter([False, False, True, True])
    assert go(lambda: next(asked))["users"].chunks == 1
    producer.quiet = True
    assert go() == {} and not State.load(str(tmp_path / "dblog_state.json")).tables["users"].done
    producer.quiet = False
    counts = go()["users"]
    assert counts.chunks >= 2 and counts.copied > 0 and State.load(str(tmp_path / "dblog_state.json")).tables["users"].done
    producer.change(10)
    go()
    got = {r.k: (r["name"], r.price, r["size"]) for r in database.read_table(spark, table='"copy"', **database.options(found)).collect()}
    assert got == {k: (n, Decimal(p), " sl"[s]) for k, (n, p, s) in producer.state.items()} and got
    assert not connection.exists("copy__incoming") and database.read_table(spark, table='"marks"', **database.options(found)).count() == 1
    assert change_log.head(str(tmp_path / "log")) == producer.pos


def test_targets_fold_a_batch_and_need_their_table(spark, db):
    found, connection = db
    connection.execute('CREATE TABLE "sink" ("a" BIGINT, "b" VARCHAR(5), "d" DECIMAL(6,1))', "INSERT INTO \"sink\" VALUES (1, 'old', 1.5), (2, 'keep', 2.5)")
    spec = TableSpec("t", "sink", ("a",), (), (ColumnSpec("a"), ColumnSpec("b"), ColumnSpec("d", "decimal")))
    target = database.DatabaseTarget(spark, found, spec)
    # no null text: Spark gives this database a CLOB for it
    ops = spark.createDataFrame([(1, "x", "7.5", "u", 1, 2), (1, "y", "8.5", "u", 2, 2), (3, "z", None, "u", 1, 2), (4, "w", "1.0", "u", 1, 2), (4, "w", None, "d", 5, 1), (9, "q", None, "d", 5, 1)], "a long, b string, d string, op string, pos long, seq int")
    for _ in range(2):
        target.apply(ops)
        assert sorted(map(tuple, target.read().collect())) == [(1, "y", Decimal("8.5")), (2, "keep", Decimal("2.5")), (3, "z", None)]
    target.close()
    with pytest.raises(SpecError, match="no table"):
        database.DatabaseTarget(spark, found, TableSpec("t", "absent", ("a",)))


def test_statements_are_undone_together(spark, db):
    found, connection = db
    connection.execute('CREATE TABLE "undo" ("a" BIGINT)')
    with pytest.raises(Exception, match="absent"):
        connection.execute('INSERT INTO "undo" VALUES (1)', 'INSERT INTO "absent" VALUES (1)')
    assert database.read_table(spark, table='"undo"', **database.options(found)).count() == 0


def test_keyset_chunks_run_in_the_database(spark, db):
    found, connection = db
    connection.execute('CREATE TABLE "T" ("A" BIGINT, "B" BIGINT, "V" VARCHAR(5))', *(f"INSERT INTO \"T\" VALUES ({a}, {b}, 'v')" for a in range(6) for b in range(5)))
    df = database.read_table(spark, table="T", skip=("V",), **database.options(found))
    assert df.columns == ["A", "B"]
    chunk = snapshot.next_chunk(df, ("A", "B"), [2, 3], 4)
    assert [tuple(r) for r in chunk.collect()] == [(2, 4), (3, 0), (3, 1), (3, 2)]
    plan = df.where(keys.after(("A", "B"), [2, 3]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*Or(GreaterThan(A,2)" in plan or "PushedFilters: [Or(GreaterThan(A,2)" in plan
    spec = TableSpec("T", "T", ("A", "B"), ("V",), tuple(map(ColumnSpec, "ABV")))
    direct = database.read_query(spark, database.chunk_query(spec, [2, 3], 4, URL), **database.options(found))
    assert sorted(map(tuple, direct.collect())) == [(2, 4), (3, 0), (3, 1), (3, 2)]


def test_settings_query(spark, db):
    more = database.options(db[0])
    database.read_settings(spark, GOOD, **more)
    with pytest.raises(SpecError, match="binlog_format"):
        database.read_settings(spark, GOOD.replace("'ROW'", "'MIXED'"), **more)
    assert database.single_row(spark.range(0)) is None and database.single_row(spark.range(5).select(F.lit(1).alias("A"))) == {"a": 1}
    with pytest.raises(SpecError, match="no literal"):
        database.literal([1])
