"""Queries of the parts of a run (log, catalogue, settings, marks, conversions), and of whole runs."""

from __future__ import annotations

import contextlib
import json
import os
import uuid
from dataclasses import asdict, replace
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes, reconcile, rows
from tidemark.operators.spec import REQUIRED_SETTINGS, SpecError, TableSpec, check_keys, check_settings, quote_source, quote_target, type_members
from tidemark.operators.snapshot import assign_chunks
from tidemark.plans.fixtures import DB, MOVED_SQL, PAYLOAD, TABLE, events_with_rows, table, window, write_log
from tidemark.plans.registry import query
from tidemark.shared import clean, made, materialize, new_path
from tidemark.sources import change_log, database
from tidemark.sources.config import Database, load_dotenv, parse_config
from tidemark.streaming import run
from tidemark.streaming.follow import await_mark

K = ("k",)


def folder(spark, name: str) -> str:
    """A new folder as a plain path where the shared folder is a local one."""
    return new_path(spark, name).removeprefix("file://")


def catalog(*columns: tuple) -> list[dict]:
    """Rows of a source's catalogue: name, type, whole type, and whether it may be null."""
    return [{"name": n, "data_type": t, "charset": "binary" if t == "blob" else None, "nullable": null, "column_type": c, "ordinal": i} for i, (n, t, c, null) in enumerate(columns)]


USERS = catalog(("k", "bigint", "bigint", False), ("value", "double", "double", True), ("props", "json", "json", True))

# --- the log ------------------------------------------------------------------------------------


@query(f"with {MOVED_SQL} select pos, case op when 'd' then 1 else 2 end as seq, k, op, case when op = 'u' then value end as value, case when op = 'u' then props end as props from moved where pos % 3 > 0 and pos > 100 and pos <= 5000")
def change_log_read(spark, sf_dir):
    """A span of the log, written as JSON lines and read by position."""
    path = folder(spark, "log")
    write_log(events_with_rows(spark, sf_dir).where("pos % 3 > 0"), path)
    spec = TableSpec(TABLE, TABLE, K).with_catalog(USERS)
    schema = spark.createDataFrame([], "k long, value double, props string").schema
    ops = rows.from_log(change_log.read_log(spark, path, 100, 5000), spec, DB, schema)
    up = F.col("op") == "u"
    return ops.select("pos", "seq", "k", "op", F.when(up, F.col("value")).alias("value"), F.when(up, F.col("props")).alias("props"))


@query("""select event_id * 2 + 1 as pos, 'shop' as db, case when (event_id // 100 * 100 // 1000 + user_id % 2) % 2 = 0 then 'users' else 'items' end as tbl from events""")
def table_numbers(spark, sf_dir):
    """Row events name a number, and map events say now and then what it stands for."""
    events = table(spark, sf_dir, "events")
    found = events.select((F.col("event_id") * 2 + 1).alias("pos"), F.lit("insert").alias("kind"), F.lit(None).cast("string").alias("db"), F.lit(None).cast("string").alias("tbl"), (F.col("user_id") % 2).cast("long").alias("table_id"))
    base = events.select((F.floor(F.col("event_id") / 100) * 100).cast("long").alias("at")).distinct().crossJoin(spark.range(2))  # two maps for each
    name = F.when((F.floor(F.col("at") / 1000) + F.col("id")) % 2 == 0, "users").otherwise("items")
    maps = base.select((F.col("at") * 2).alias("pos"), F.lit("map").alias("kind"), F.lit(DB).alias("db"), name.alias("tbl"), F.col("id").alias("table_id"))
    return changes.resolve_tables(found.union(maps)).where("kind = 'insert'").select("pos", "db", "tbl")


@query("select event_id as pos, md5(event_id::varchar) as mark_id from events where event_id % 4 = 3 and event_id % 3 = 0")
def mark_rows(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.when(F.col("event_id") % 4 == 3, "mark").otherwise("insert").alias("kind"),
        F.when(F.col("event_id") % 3 == 0, DB).otherwise("other").alias("db"),
        F.when(F.col("event_id") % 4 == 3, "marks").otherwise(TABLE).alias("tbl"),
        F.md5(F.col("event_id").cast("string").cast("binary")).alias("mark_id"),
    )
    return changes.marks(log, DB, "marks").select("pos", "mark_id")


@query("select 100 as n, 100 as n_distinct, 32 as length, true as hexadecimal")
def new_marks(spark, sf_dir):
    made = [changes.new_mark() for _ in range(100)]
    whole = all(set(m) <= set("0123456789abcdef") for m in made)
    return spark.createDataFrame([(len(made), len(set(made)), len(made[0]), whole)], "n int, n_distinct int, length int, hexadecimal boolean")


@query("select event_id, user_id as k, event_type as kind, value::varchar as value from events")
def cells_to_row(spark, sf_dir):
    """Positional cells as a row."""
    found = table(spark, sf_dir, "events").select("event_id", F.array(F.col("user_id").cast("string"), F.col("event_type"), F.col("value").cast("string")).alias("cells"))
    row = changes.cells_to_row(F.col("cells"), ["k", "kind", "value"])
    kind = table(spark, sf_dir, "events").schema["user_id"].dataType
    return found.select("event_id", row.alias("r")).select("event_id", F.col("r.k").cast(kind).alias("k"), "r.kind", "r.value")


@query("select * from (values ('silent', null::bigint, 6), ('moving', 42::bigint, 30), ('at once', 7::bigint, 0)) t(log, pos, seconds)")
def awaited_marks(spark, sf_dir):
    """A mark that never comes, one that comes late in a log that moves, and one that is there."""
    out = []
    for name, finds, heads in (("silent", [], [1]), ("moving", [None] * 30 + [42], range(100)), ("at once", [7], [1])):
        now, find, head = [0], iter(finds), iter(heads)
        last = [None]

        def step(s, now=now):
            now[0] += int(s)

        def at(head=head, last=last):
            last[0] = next(head, last[0])
            return last[0]

        pos = await_mark(lambda find=find: next(find, None), at, 6, clock=lambda now=now: now[0], sleep=step)
        out.append((name, pos, now[0]))
    return spark.createDataFrame(out, "log string, pos long, seconds int")


# --- catalogue, settings, configuration ---------------------------------------------------------

_TYPES = [
    ("k", "bigint", "bigint unsigned", False), ("tags", "set", "set('a','b''c')", True), ("size", "enum", "enum('s','l')", True), ("flags", "bit", "bit(12)", True),
    ("price", "decimal", "decimal(10,2)", True), ("doc", "json", "json", True), ("raw", "blob", "blob", True), ("place", "geometry", "geometry", True), ("day", "date", "date", True),
]


@query("""select * from (values (0, 'k', 'plain', true, '', 64), (1, 'tags', 'set', false, 'a|b''c', 64), (2, 'size', 'enum', false, 's|l', 64), (3, 'flags', 'bit', false, '', 12),
  (4, 'price', 'decimal', false, '', 64), (5, 'doc', 'json', false, '', 64), (6, 'raw', 'binary', false, '', 64), (7, 'place', 'binary', false, '', 64), (8, 'day', 'plain', false, '', 64)) t(n, name, kind, is_unsigned, members, bits)""")
def catalog_kinds(spark, sf_dir):
    """Columns from rows of a catalogue that come in any order."""
    spec = TableSpec("t", "t", K).with_catalog(catalog(*_TYPES)[::-1])
    return spark.createDataFrame([(i, c.name, c.kind, c.unsigned, "|".join(c.members), c.bits) for i, c in enumerate(spec.columns)], "n int, name string, kind string, is_unsigned boolean, members string, bits int")


@query(r"""select * from (values ('set(''a'',''b'')', 'a|b'), ('enum(''it''''s'')', 'it''s'), ('int(11)', ''), ('set(''x,y'','')'')', 'x,y|)'), ('enum(''a\''b'')', 'a''b')) t(column_type, members)""")
def members_of_types(spark, sf_dir):
    types = ["set('a','b')", "enum('it''s')", "int(11)", "set('x,y',')')", r"enum('a\'b')"]
    return spark.createDataFrame([(t, "|".join(type_members(t))) for t in types], "column_type string, members string")


def _refused(check, *args) -> str | None:
    try:
        check(*args)
    except SpecError as e:
        return str(e)
    return None


@query("""select * from (values ('as required', true, null), ('in lower case', true, null), ('mixed', false, 'binlog_format'), ('minimal', false, 'binlog_row_image'), ('missing', false, 'binlog_row_metadata')) t(source, accepted, setting)""")
def source_settings(spark, sf_dir):
    """Settings that come as one row of the source."""
    good = REQUIRED_SETTINGS
    cases = {"as required": good, "in lower case": {k: v.lower() for k, v in good.items()}, "mixed": good | {"binlog_format": "MIXED"}, "minimal": good | {"binlog_row_image": "MINIMAL"}, "missing": {k: v for k, v in good.items() if k != "binlog_row_metadata"}}
    out = []
    for name, found in cases.items():
        row = database.single_row(spark.createDataFrame([tuple(found.values())], ", ".join(f"{k.upper()} string" for k in found)))
        said = _refused(check_settings, row)
        out.append((name, said is None, said.split()[0] if said else None))
    return spark.createDataFrame(out, "source string, accepted boolean, setting string")


@query("""select 'orders' as tbl, 'o_orderkey' as key, not exists (select 1 from orders where o_orderkey is null) as accepted
  union all select 'halved', 'o_orderkey', not exists (select 1 from orders where o_orderkey % 2 = 1)
  union all select 'orders', 'o_custkey,o_orderkey', true""")
def null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    halved = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")))
    cases = [("orders", orders, ("o_orderkey",)), ("halved", halved, ("o_orderkey",)), ("orders", orders, ("o_custkey", "o_orderkey"))]
    return spark.createDataFrame([(n, ",".join(k), _refused(check_keys, df, k) is None) for n, df, k in cases], "tbl string, key string, accepted boolean")


@query("""select * from (values ('chunk_size', '1000'), ('watermark_table', 'dblog_watermarks'), ('watermark_timeout_seconds', '120'), ('state_file', 'dblog_state.json'), ('server_id', '100'), ('heartbeat_seconds', '10'),
  ('source.host', '127.0.0.1'), ('source.port', '3306'), ('target.port', '5433'), ('tables', 'users:public.users:id:secret')) t(name, value)""")
def configuration(spark, sf_dir):
    """A configuration with what it leaves out."""
    about = {"user": "u", "db": DB, "password_env": "P"}
    found = parse_config({"mysql": about, "postgres": about | {"port": 5433}, "tables": [{"mysql_table": "users", "pg_table": "public.users", "key_columns": ["id"], "skip_columns": ["secret"]}]})
    names = ("chunk_size", "watermark_table", "watermark_timeout_seconds", "state_file", "server_id", "heartbeat_seconds")
    out = [(n, str(getattr(found, n))) for n in names] + [("source.host", found.source.host), ("source.port", str(found.source.port_or(3306))), ("target.port", str(found.target.port_or(5432)))]
    out += [("tables", ":".join((t.source, t.target, *t.keys, *t.skip))) for t in found.tables]
    return spark.createDataFrame(out, "name string, value string")


@query("select * from (values ('TIDEMARK_Q1', 'x y'), ('TIDEMARK_Q2', 'z'), ('TIDEMARK_Q3', 'as it was'), ('TIDEMARK_Q4', 'plain')) t(name, value)")
def environment_file(spark, sf_dir):
    """Variables of the nearest file upward; those that are set already stay."""
    top = folder(spark, "dotenv")
    os.makedirs(f"{top}/a/b")
    with open(f"{top}/.env", "w") as f:
        f.write("# comment\n\nexport TIDEMARK_Q1='x y'\nTIDEMARK_Q2=\"z\"\nTIDEMARK_Q3=new\nTIDEMARK_Q4 = plain \nnothing\n")
    names = [f"TIDEMARK_Q{i}" for i in range(1, 5)]
    os.environ["TIDEMARK_Q3"] = "as it was"
    try:
        load_dotenv(f"{top}/a/b")
        return spark.createDataFrame([(n, os.environ[n]) for n in names], "name string, value string")
    finally:
        for n in names:
            os.environ.pop(n, None)


@query("select n_nationkey, '`' || n_name || '.a``b`' as at_source, '\"' || n_name || '\".\"a`b\"' as at_target from nation")
def quoted_names(spark, sf_dir):
    named = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()
    key = table(spark, sf_dir, "nation").schema["n_nationkey"].dataType.simpleString()
    return spark.createDataFrame([(r[0], quote_source(f"{r[1]}.a`b"), quote_target(f"{r[1]}.a`b")) for r in named], f"n_nationkey {key}, at_source string, at_target string")


# --- conversions --------------------------------------------------------------------------------

CELLS = catalog(("k", "bigint", "bigint", False), ("tags", "set", "set('red','green','blue')", True), ("size", "enum", "enum('low','mid','high')", True), ("flags", "bit", "bit(12)", True), ("small", "tinyint", "tinyint unsigned", True), ("n", "int", "int unsigned", True), ("big", "bigint", "bigint unsigned", True), ("price", "decimal", "decimal(18,2)", True), ("raw", "blob", "blob", True), ("day", "date", "date", True), ("span", "time", "time", True), ("secret", "varchar", "varchar(5)", True))
_TAGS = "array_to_string(list_sort(list_filter([case when k & 1 > 0 then 'red' end, case when k & 2 > 0 then 'green' end, case when k & 4 > 0 then 'blue' end], lambda x: x is not null)), ',')"


@query(f"""with v as (select o_orderkey as k, o_totalprice, o_orderdate from orders),
  c as (select k, {_TAGS} as tags, case k % 4 when 0 then '' when 1 then 'low' when 2 then 'mid' else 'high' end as size, k % 4096 as flags, k % 256 as small, k * 777777 % 4294967296 as n,
    (18446744073709551615::hugeint - k)::varchar as big, o_totalprice::decimal(18,2)::varchar as price, lower(hex(encode(k::varchar))) as raw, strftime(o_orderdate, '%Y-%m-%d') as day,
    (k % 24)::varchar || ':00:' || lpad((k % 60)::varchar, 2, '0') as span from v)
select route, c.* from c cross join (values ('snapshot'), ('log')) r(route)""")
def cells_of_both_routes(spark, sf_dir):
    """Every kind of column, as a snapshot has it and as the log has it."""
    spec = TableSpec("t", "t", K, ("secret",)).with_catalog(CELLS)
    k = F.col("o_orderkey").cast("long")
    micros = (k % 24) * 3_600_000_000 + (k % 60) * 1_000_000
    low12 = F.unhex(F.lpad(F.hex(k % 4096), 4, "0"))
    text = F.concat_ws(",", *[F.when(F.shiftright(k, i).bitwiseAND(1) == 1, m) for i, m in ((2, "blue"), (0, "red"), (1, "green"))])
    label = F.element_at(F.array(F.lit(""), F.lit("low"), F.lit("mid"), F.lit("high")), (k % 4 + 1).cast("int"))
    n = k * 777777 % 4294967296
    big = F.lit(Decimal((1 << 64) - 1)) - k
    orders = table(spark, sf_dir, "orders")
    price, raw, day = F.col("o_totalprice").cast("decimal(18,2)"), k.cast("string").cast("binary"), F.to_date("o_orderdate")
    snapshot = orders.select(k.alias("k"), text.alias("tags"), label.alias("size"), low12.alias("flags"), (k % 256).cast("int").alias("small"), n.alias("n"), big.cast("decimal(20,0)").alias("big"), price.alias("price"), raw.alias("raw"), day.alias("day"), micros.alias("span"), F.lit("x").alias("secret"))
    signed = lambda c, bits: F.when(c >= 1 << (bits - 1), c - (1 << bits)).otherwise(c)
    after = F.struct(
        k.alias("k"), (k % 8).alias("tags"), (k % 4).alias("size"), F.base64(low12).alias("flags"), signed(k % 256, 8).alias("small"), signed(n, 32).alias("n"), (-1 - k).alias("big"),
        price.cast("string").alias("price"), F.base64(raw).alias("raw"), F.date_format(day, "yyyy-MM-dd").alias("day"), micros.alias("span"), F.lit("x").alias("secret"),
    )
    change = F.struct(F.lit(None).cast("string").alias("before"), F.to_json(after, {"ignoreNullFields": "false"}).alias("after"))
    events = orders.select(k.alias("pos"), F.lit("insert").alias("kind"), F.lit(DB).alias("db"), F.lit("t").alias("tbl"), F.array(change).alias("changes"))
    here = rows.from_snapshot(snapshot, spec)
    there = rows.from_log(events, spec, DB, here.schema)
    show = [F.col("k"), "tags", "size", F.col("flags"), F.col("small").cast("long").alias("small"), F.col("n"), F.col("big").cast("string").alias("big"), "price", F.lower(F.hex("raw")).alias("raw"), F.date_format("day", "yyyy-MM-dd").alias("day"), "span"]
    return here.select(F.lit("snapshot").alias("route"), *show).union(there.select(F.lit("log").alias("route"), *show))


# --- whole runs ---------------------------------------------------------------------------------


def _two_tables(spark, sf_dir: str) -> DataFrame:
    """Events of users (even keys) and items (odd ones); a move keeps a key's parity."""
    events = events_with_rows(spark, sf_dir)
    key = F.coalesce(F.col("changes")[0]["before"]["k"], F.col("changes")[0]["after"]["k"])
    return events.drop("txn").withColumn("tbl", F.when(key % 2 == 0, "users").otherwise("items"))


def _snapshot(spark, sf_dir: str, workspace: str, name: str, parity: int, pos: int) -> None:
    from tidemark.plans.catalogue import moved_ops

    seen = reconcile.latest_state(moved_ops(spark, sf_dir).where((F.col("pos") <= pos) & (F.col("k") % 2 == parity)), K, PAYLOAD)
    seen.write.parquet(f"{workspace}/source/{name}")
    with open(f"{workspace}/source/{name}.json", "w") as f:
        json.dump({"pos": pos, "columns": USERS}, f)


def _workspace(spark, sf_dir: str, late: int | None = None):
    """Two snapshots of different moments, the log, and the configuration; ``late`` is another position for the first snapshot."""
    low, at, high = window(spark, sf_dir)
    path = folder(spark, "run")
    for name, parity, pos in (("users", 0, low if late is None else late), ("items", 1, high)):
        _snapshot(spark, sf_dir, path, name, parity, pos)
    write_log(_two_tables(spark, sf_dir), f"{path}/log")
    about = {"user": "u", "db": DB, "password_env": "P"}
    config = parse_config({"mysql": about, "postgres": about, "tables": [{"mysql_table": t, "pg_table": t, "key_columns": ["k"]} for t in ("users", "items")]})
    return path, config, at


_TO_COMMIT = "(select max(event_id) from events where event_id % 10 = 9)"


@query(f"""with {MOVED_SQL} select case when k % 2 = 0 then 'users' else 'items' end as tbl, k, value, props
  from (select *, row_number() over (partition by k order by pos desc, seq desc) as n from moved where pos <= {_TO_COMMIT}) where n = 1 and op <> 'd'""")
def replicated_tables(spark, sf_dir):
    """A run over two tables: snapshots of two moments, a stop between them, resume, and the log to its last commit."""
    path, config, _ = _workspace(spark, sf_dir)
    asked = iter([False, False] + [True] * 9)
    run.replicate(spark, path, config, lambda: next(asked), once=True)
    work = run.Replication(spark, path, config)
    with contextlib.closing(work):
        work.open()
        work.backfill(lambda: False)
        work.follow(lambda: False, once=True)
        states = [t.target.read().select(F.lit(n).alias("tbl"), "k", "value", "props") for n, t in work.tables.items()]
    return states[0].union(states[1])


@query("select * from (values ('users', false, 0), ('items', true, 1)) t(tbl, done, chunks)")
def interrupted_window(spark, sf_dir):
    """The first table's snapshot is newer than the log: its window stays open, the next table is copied, and the log is not followed."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).head()[0]
    path, config, _ = _workspace(spark, sf_dir, late=last + 1000)
    counts = run.replicate(spark, path, config, once=True)
    state = run.State.load(f"{path}/{config.state_file}")
    assert not os.path.exists(f"{path}/checkpoints")
    return spark.createDataFrame([(n, state.tables[n].done, asdict(counts[n])["chunks"] if n in counts else 0) for n in ("users", "items")], "tbl string, done boolean, chunks int")


_DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


class _Source:
    """Customers in an embedded database, and who writes its log: marks as they are set, and some changes after the first of them."""

    def __init__(self, spark, sf_dir: str, log: str) -> None:
        os.environ.setdefault("TIDEMARK_EMBEDDED", "")
        settings = "select " + ", ".join(f"'{v}' as {n}" for n, v in REQUIRED_SETTINGS.items()) + " from SYSIBM.SYSDUMMY1"
        self.about = {"user": "app", "db": DB, "password_env": "TIDEMARK_EMBEDDED", "url": f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true", "driver": _DERBY, "settings_query": settings}
        self.database = Database(**self.about)
        self.spark, self.log, self.pos, self.seen, self.now = spark, log, 0, set(), 0
        self.connection = database.Connection(spark, self.database)
        columns = '("c_custkey" BIGINT PRIMARY KEY, "c_name" VARCHAR(40), "c_acctbal" DECIMAL(14,2))'
        about = [("c_custkey", "bigint", "NO"), ("c_name", "varchar", "YES"), ("c_acctbal", "decimal", "YES")]
        self.connection.execute(
            f'CREATE TABLE "customer" {columns}', f'CREATE TABLE "copied" {columns}', 'CREATE TABLE "marks" ("id" VARCHAR(32))',
            "CREATE TABLE INFORMATION_SCHEMA.COLUMNS (TABLE_SCHEMA VARCHAR(9), TABLE_NAME VARCHAR(9), COLUMN_NAME VARCHAR(9), DATA_TYPE VARCHAR(9), CHARACTER_SET_NAME VARCHAR(9), IS_NULLABLE VARCHAR(3), COLUMN_TYPE VARCHAR(9), ORDINAL_POSITION BIGINT)",
            *(f"INSERT INTO INFORMATION_SCHEMA.COLUMNS VALUES ('{DB}', 'customer', '{n}', '{t}', NULL, '{null}', '{t}', {i})" for i, (n, t, null) in enumerate(about)),
        )
        self.options = database.options(self.database)
        customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long"), "c_name", F.col("c_acctbal").cast("decimal(14,2)").alias("c_acctbal"))
        database.write_table(customers, "customer", **self.options)
        os.makedirs(log)

    def close(self) -> None:
        """Let go of the database, which lives in memory."""
        self.connection.close()
        with contextlib.suppress(Exception):  # that it is gone comes as an error
            database.Connection(self.spark, replace(self.database, url=self.database.url.replace("create=true", "drop=true")))

    def event(self, **about) -> None:
        self.pos += 1
        with open(f"{self.log}/{self.pos:012d}.jsonl", "w") as f:
            f.write(json.dumps({"pos": self.pos, "db": DB, "is_commit": True} | about))

    def go_on(self, seconds: float) -> None:
        self.now += seconds
        for r in database.read_table(self.spark, table='"marks"', **self.options).collect():
            if r[0] not in self.seen:
                self.seen.add(r[0])
                self.event(tbl="marks", kind="mark", mark_id=r[0])
        if len(self.seen) == 1 and self.pos == 1:
            self.change()

    def change(self) -> None:
        """A transaction on every tenth row; an event of the log has 1,000 changes at most."""
        rows = database.read_table(self.spark, table='"customer"', **self.options).where("c_custkey % 10 = 0")
        held = assign_chunks(rows, ("c_custkey",), 1000, carry=("c_name", "c_acctbal"))
        self.connection.execute('UPDATE "customer" SET "c_acctbal" = "c_acctbal" + 1 WHERE MOD("c_custkey", 10) = 0')
        last = held.agg(F.max("chunk_id")).head()[0]
        if last is not None:
            side = lambda balance: F.struct("c_custkey", "c_name", balance.cast("string").alias("c_acctbal"))
            change = F.struct(side(F.col("c_acctbal")).alias("before"), side(F.col("c_acctbal") + 1).alias("after"))
            events = held.groupBy("chunk_id").agg(F.collect_list(change).alias("changes"))
            about = [F.lit(DB).alias("db"), F.lit("customer").alias("tbl"), F.lit("update").alias("kind"), (F.col("chunk_id") == last).alias("is_commit"), "changes"]
            write_log(events.select((F.col("chunk_id") + self.pos + 1).alias("pos"), *about), self.log)
            self.pos += last + 1


@query("select c_custkey, c_name, (c_acctbal::decimal(14,2) + case when c_custkey % 10 = 0 then 1 else 0 end)::varchar as c_acctbal from customer")
def replicated_database(spark, sf_dir):
    """From database to database: settings, catalogue, marks, chunks by key, a staging table, and changes between the marks."""
    before, path = made(), folder(spark, "database")
    source = _Source(spark, sf_dir, f"{path}/log")
    with contextlib.closing(source):
        n = table(spark, sf_dir, "customer").count()
        config = parse_config({"mysql": source.about, "postgres": source.about, "chunk_size": n // 2 + 1, "watermark_table": "marks", "tables": [{"mysql_table": "customer", "pg_table": "copied", "key_columns": ["c_custkey"]}]})
        run.replicate(spark, path, config, once=True, source=run.DatabaseSource(spark, path, config, sleep=source.go_on, clock=lambda: source.now))
        key = table(spark, sf_dir, "customer").schema["c_custkey"].dataType
        copied = database.read_table(spark, table='"copied"', **source.options)
        found = materialize(copied.select(F.col("c_custkey").cast(key).alias("c_custkey"), "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal")), "copied")
    clean(spark, before, but=(found,))
    return found
