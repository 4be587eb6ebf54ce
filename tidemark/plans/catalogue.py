"""The query catalogue: every operator on the driver's tables, with DuckDB SQL of the same result."""

from __future__ import annotations

import json
import os
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cells
from tidemark.operators import changes, keys, merge, reconcile, snapshot
from tidemark.operators.spec import ColumnSpec
from tidemark.plans import runs  # noqa: F401  its queries are registered as well
from tidemark.plans.fixtures import DB, LOG_SQL, MOVED_SQL, PAYLOAD, TABLE, WINDOW_SQL, events_with_rows, from_events, log, table, window
from tidemark.plans.registry import FOUND, SQL, query
from tidemark.shared import new_path
from tidemark.sources.config import Progress, State
from tidemark.streaming.follow import follow

K = ("k",)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
MEMBERS = ("red", "green", "blue")
LABELS = ("low", "mid", "high", "top")
STATEMENTS = [
    (1, "alter table t add c int", "shop"),
    (2, "ALTER TABLE other.t add c int", "other"),
    (3, "drop table `shop`.t", "other"),
    (4, "BEGIN", "shop"),
    (5, "/*c*/ drop table t", "shop"),
    (6, "create table workshop.t (i int)", "other"),
    (7, "  truncate t", "shop"),
    (8, "insert into shop.t values (1)", "shop"),
    (9, "rename table shop.a to shop.b", "other"),
    (10, "\n\tALTER TABLE t drop c", "shop"),
    (11, "\tDROP\ttable t", "shop"),
    (12, "altered", "shop"),
]

LATEST_SQL = "select k, value, props from (select *, row_number() over (partition by k order by pos desc, seq desc) as n from {0}) where n = 1 and op <> 'd'"


def moved_ops(spark, sf_dir: str) -> DataFrame:
    """Operations by key of the log whose keys move, through the event decoder."""
    events = changes.ours(events_with_rows(spark, sf_dir), DB, [TABLE])
    return changes.operations(changes.row_changes(events)).select("pos", "seq", "txn", "is_commit", "op", "row.k", F.when(F.col("op") != "d", F.col("row.value")).alias("value"), F.when(F.col("op") != "d", F.col("row.props")).alias("props"))


# --- folds ------------------------------------------------------------------------------------


@query(f"with {LOG_SQL} {LATEST_SQL.format('log')}")
def latest_state(spark, sf_dir):
    return reconcile.latest_state(log(spark, sf_dir), K, PAYLOAD)


@query(f"with {MOVED_SQL} {LATEST_SQL.format('moved')}")
def key_change_apply(spark, sf_dir):
    return reconcile.latest_state(moved_ops(spark, sf_dir), K, PAYLOAD)


@query(f"""with {LOG_SQL} select pos, 0 as n, (case when op <> 'c' or pos % 17 = 0 then k end)::varchar as before_k,
  (case when op <> 'd' then case when pos % 17 = 0 then k + 1000 else k end end)::varchar as after_k from log""")
def explode_row_changes(spark, sf_dir):
    found = changes.row_changes(events_with_rows(spark, sf_dir))
    return found.select("pos", "n", F.col("before.k").cast("string").alias("before_k"), F.col("after.k").cast("string").alias("after_k"))


@query("""select * from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc,
    l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as n from lineitem) where n = 1)""")
def dedup_last_wins(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return reconcile.dedup_last(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"), [F.col(c) for c in order]).drop("l_shipdate")


# --- chunks -----------------------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 1000")
def chunk_first(spark, sf_dir):
    return snapshot.next_chunk(table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), ("o_orderkey",), None, 1000)


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey > 700 order by o_orderkey limit 500")
def chunk_after_single(spark, sf_dir):
    return snapshot.next_chunk(table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), ("o_orderkey",), [700], 500)


@query("select conv_id, turn, role, text from conversations where (conv_id, turn) > (10, 2) order by conv_id, turn limit 50")
def chunk_after_composite(spark, sf_dir):
    return snapshot.next_chunk(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ("conv_id", "turn"), [10, 2], 50)


@query("select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 100 as chunk_id from orders")
def chunk_assign(spark, sf_dir):
    return snapshot.assign_chunks(table(spark, sf_dir, "orders"), ("o_orderkey",), 100)


@query("""select chunk_id, max(o_orderkey) as last_key, count(*) as n_rows from (
  select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 100 as chunk_id from orders) group by chunk_id""")
def chunk_cursors(spark, sf_dir):
    assigned = snapshot.assign_chunks(table(spark, sf_dir, "orders"), ("o_orderkey",), 100)
    return snapshot.chunk_cursors(assigned, ("o_orderkey",)).select("chunk_id", F.col("last_key.o_orderkey").alias("last_key"), "n_rows")


# --- cells ------------------------------------------------------------------------------------


@query("""select o_orderkey, o_orderkey as bits_16, (18446744073709551615::hugeint - o_orderkey)::varchar as bits_64, (o_orderkey % 2)::bigint as flag, o_orderkey % 8 as listed from orders""")
def bit_to_int(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = F.unhex(F.lpad(F.hex("o_orderkey"), 16, "0"))
    wide = F.unhex(F.hex(-1 - F.col("o_orderkey")))
    bits = F.transform(F.array(F.lit(4), F.lit(2), F.lit(1)), lambda b: F.floor(F.col("o_orderkey") % 8 / b) % 2 == 1)
    return orders.select(
        "o_orderkey",
        cells.bit_to_int(raw, T.BinaryType(), 16).alias("bits_16"),
        cells.bit_to_int(wide, T.BinaryType()).cast("string").alias("bits_64"),
        cells.bit_to_int(F.col("o_orderkey") % 2 == 1, T.BooleanType()).alias("flag"),
        cells.bit_to_int(bits, T.ArrayType(T.BooleanType()), 3).alias("listed"),
    )


_SIGNED = {"tinyint": (8, "byte"), "smallint": (16, "short"), "mediumint": (24, "int"), "int": (32, "int")}


def _low_64(whole):
    """The low 64 bits of a decimal as a signed integer: what a column of that width holds."""
    low = F.pmod(whole, F.lit(Decimal(1 << 64)))
    return F.when(low >= Decimal(1 << 63), low - Decimal(1 << 64)).otherwise(low).cast("long")


@query("""select o_orderkey, case when t < 0 then t + 256 else t end as u_tinyint, case when s < 0 then s + 65536 else s end as u_smallint,
  case when m < 0 then m + 16777216 else m end as u_mediumint, case when i < 0 then i + 4294967296 else i end as u_int,
  case when b < 0 then (b::hugeint + 18446744073709551616)::varchar else b::varchar end as u_bigint
  from (select o_orderkey, o_orderkey * 7 % 256 - 128 as t, o_orderkey * 77 % 65536 - 32768 as s, o_orderkey * 7777 % 16777216 - 8388608 as m,
    o_orderkey * 777777 % 4294967296 - 2147483648 as i, (o_orderkey - 500) * 600000000000000 as b from orders)""")
def unsigned_from_log(spark, sf_dir):
    k = F.col("o_orderkey")
    source = {"tinyint": k * 7, "smallint": k * 77, "mediumint": k * 7777, "int": k * 777777}
    out = []
    for name, (bits, kind) in _SIGNED.items():
        signed = (source[name] % (1 << bits) - (1 << (bits - 1))).cast(kind)
        out.append(cells.signedness(signed, ColumnSpec("c", "plain", name, True)).alias(f"u_{name}"))
    wide = (k.cast("decimal(20,0)") - 500) * Decimal(600_000_000_000_000)  # beyond 64 bits from key 15,873 on
    big = cells.signedness(_low_64(wide), ColumnSpec("c", "plain", "bigint", True))
    return table(spark, sf_dir, "orders").select("o_orderkey", *out, big.cast("string").alias("u_bigint"))


_SET_SQL = "array_to_string(list_sort(list_filter([case when m & 1 > 0 then 'red' end, case when m & 2 > 0 then 'green' end, case when m & 4 > 0 then 'blue' end], lambda x: x is not null)), ',')"


@query(f"select o_orderkey, {_SET_SQL} as members from (select o_orderkey, o_orderkey % 16 as m from orders)")
def set_from_mask(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cells.set_to_text(F.col("o_orderkey") % 16, T.LongType(), MEMBERS).alias("members"))


@query(f"select o_orderkey, {_SET_SQL} as members from (select o_orderkey, o_orderkey % 8 as m from orders)")
def set_from_text(spark, sf_dir):
    chosen = [F.when(F.shiftright("o_orderkey", i).bitwiseAND(1) == 1, m) for i, m in enumerate(MEMBERS)]
    text = F.array_join(F.array_compact(F.array(*chosen)), ",")
    return table(spark, sf_dir, "orders").select("o_orderkey", cells.set_to_text(text, T.StringType(), MEMBERS).alias("members"))


@query("select o_orderkey, case i when 0 then '' when 1 then 'low' when 2 then 'mid' when 3 then 'high' when 4 then 'top' else i::varchar end as label from (select o_orderkey, o_orderkey % 7 as i from orders)")
def enum_from_index(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cells.enum_to_text(F.col("o_orderkey") % 7, T.LongType(), LABELS).alias("label"))


@query("select o_orderkey, o_totalprice::decimal(18,2)::varchar as price from orders")
def decimal_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cells.decimal_to_text(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"))


@query("""with v as (select event_id, event_id * 1234567891 - 2000000000000 + case when event_id % 3 = 0 then -(event_id * 1234567891 % 1000000) else 0 end as us from events),
  p as (select event_id, us, ((us % 86400000000) + 86400000000) % 86400000000 as rest from v), q as (select event_id, rest, (us - rest) // 86400000000 as days from p)
select event_id, case when days = 0 then '' else days::varchar || case when abs(days) = 1 then ' day, ' else ' days, ' end end
  || (rest // 3600000000)::varchar || ':' || lpad((rest // 60000000 % 60)::varchar, 2, '0') || ':' || lpad((rest // 1000000 % 60)::varchar, 2, '0')
  || case when rest % 1000000 = 0 then '' else '.' || lpad((rest % 1000000)::varchar, 6, '0') end as duration from q""")
def time_format(spark, sf_dir):
    whole = F.col("event_id") * 1234567891
    micros = whole - 2_000_000_000_000 + F.when(F.col("event_id") % 3 == 0, -(whole % 1_000_000)).otherwise(0)
    return table(spark, sf_dir, "events").select("event_id", cells.time_to_text(micros).alias("duration"))


@query("select event_id, props as doc, json_extract_string(props, '$.k') as k from events")
def json_text(spark, sf_dir):
    doc = cells.canonical(F.col("props"), T.StringType(), ColumnSpec("props", "json", "json"), False)
    return table(spark, sf_dir, "events").select("event_id", doc.alias("doc"), F.get_json_object(doc, "$.k").alias("k"))


@query("select doc_id, sha256(text) as content_sha256, text from documents")
def binary_roundtrip(spark, sf_dir):
    digest = F.unhex(F.sha2("text", 256))
    back = cells.to_text(cells.to_bytes(F.col("text"), T.StringType()))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(F.hex(cells.to_bytes(digest, T.BinaryType()))).alias("content_sha256"), back.alias("text"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate - interval 2 hour, '%Y-%m-%d %H:%M:%S') as utc from orders")
def date_and_ts(spark, sf_dir):
    day = cells.canonical(F.col("o_orderdate"), T.TimestampNTZType(), ColumnSpec("d", "plain", "date"), True)
    zoned = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")).cast("timestamp")
    utc = cells.canonical(zoned, T.TimestampType(), ColumnSpec("t", "plain", "timestamp"), True)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("utc"))


# --- keys -------------------------------------------------------------------------------------


@query("select conv_id, turn, 'int:' || conv_id || '|int:' || turn || '|str:' || role || '|bytes:' || lower(hex(encode(role))) as identity from conversations")
def encode_key(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("raw", F.encode("role", "UTF-8"))
    identity = keys.row_identity(rows, ("conv_id", "turn", "role", "raw"), {"raw": ColumnSpec("raw", "binary", "varbinary")})
    return rows.select("conv_id", "turn", F.array_join(F.transform(identity, lambda p: F.concat_ws(":", p["type"], p["text"])), "|").alias("identity"))


@query("select conv_id, turn, conv_id as conv_id_back, turn as turn_back, role as role_back, (18446744073709551615::hugeint - conv_id)::varchar as big_back from conversations")
def decode_key(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("big", (F.lit(Decimal((1 << 64) - 1)) - F.col("conv_id")).cast("decimal(20,0)"))
    rows = rows.withColumn("__id", keys.row_identity(rows, ("conv_id", "turn", "role", "big")))
    part = lambda i, kind: keys.decode(F.col("__id")[i], kind)
    turn = rows.schema["turn"].dataType.simpleString()
    return rows.select("conv_id", "turn", part(0, "bigint").alias("conv_id_back"), part(1, turn).alias("turn_back"), part(2, "string").alias("role_back"), part(3, "decimal(38,0)").cast("string").alias("big_back"))


# --- windows ----------------------------------------------------------------------------------

_SNAP_SQL = f"{MOVED_SQL}, {WINDOW_SQL}, snap as ({LATEST_SQL.format('(select moved.* from moved, w where pos <= t)')}), changed as (select distinct k from moved, w where pos > lw and pos <= hw)"


def _window_parts(spark, sf_dir):
    low, at, high = window(spark, sf_dir)
    ops = moved_ops(spark, sf_dir)
    return reconcile.latest_state(ops.where(F.col("pos") <= at), K, PAYLOAD), ops, low, high


@query(f"with {_SNAP_SQL} select k from changed")
def changed_keys_window(spark, sf_dir):
    _, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.changed_keys(ops, K, low, high)


@query(f"with {_SNAP_SQL} select k, value, props from snap where k not in (select k from changed)")
def reconcile_fresh(spark, sf_dir):
    snap, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.fresh(snap, reconcile.changed_keys(ops, K, low, high), K)


@query(f"with {_SNAP_SQL} select k, value, props from snap where k in (select k from changed)")
def reconcile_superseded(spark, sf_dir):
    snap, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.superseded(snap, reconcile.changed_keys(ops, K, low, high), K)


@query(f"""with {_SNAP_SQL}, c as (select k, (row_number() over (order by k) - 1) // 20 as chunk_id from snap)
select chunk_id, count(*) filter (k not in (select k from changed)) as fresh, count(*) filter (k in (select k from changed)) as superseded, count(*) as total from c group by chunk_id""")
def reconcile_counts(spark, sf_dir):
    snap, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.counts(snapshot.assign_chunks(snap, K, 20), reconcile.changed_keys(ops, K, low, high), K, "chunk_id")


_HIGH_SQL = f"with {MOVED_SQL}, {WINDOW_SQL} {LATEST_SQL.format('(select moved.* from moved, w where pos <= hw)')}"


@query(_HIGH_SQL)
def backfill_final_state(spark, sf_dir):
    snap, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.backfill_chunk(snap, ops, K, PAYLOAD, low, high)


@query(_HIGH_SQL)
def stamped_fold(spark, sf_dir):
    snap, ops, low, high = _window_parts(spark, sf_dir)
    return reconcile.stamped_fold(snap, ops, K, PAYLOAD, low, high)


# --- events -----------------------------------------------------------------------------------


@query("select c_custkey, c_name from customer where c_custkey % 3 <> 0")
def delete_apply(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    gone = target.where("c_custkey % 3 = 0").select("c_custkey").union(spark.range(-3, 0).select("id"))
    return merge.delete(target, gone, ("c_custkey",))


_STATEMENTS_SQL = ", ".join(f"({i}, '{s}', '{d}')" for i, s, d in STATEMENTS)


@query(f"""select n, upper(regexp_extract(statement, '^\\s*(\\S+)', 1)) in ('CREATE', 'ALTER', 'DROP', 'TRUNCATE', 'RENAME')
  and (db = 'shop' or contains(lower(statement), '`shop`.') or contains(lower(statement), 'shop.')) as aborts,
  n in (1, 3, 5, 7, 9, 10, 11) as aborts_strict
  from (values {_STATEMENTS_SQL}) t(n, statement, db)""")
def ddl_guard(spark, sf_dir):
    rows = spark.createDataFrame(STATEMENTS, "n int, statement string, db string")
    args = (F.col("statement"), F.col("db"), DB)
    return rows.select("n", changes.is_ddl(*args).alias("aborts"), changes.is_ddl_strict(*args).alias("aborts_strict"))


@query(f"with {LOG_SQL} select pos, k, op from log where pos <= (select max(pos) from log where is_commit and pos <= (select max(event_id) - 5 from events))")
def txn_cut(spark, sf_dir):
    ops = log(spark, sf_dir)
    head = ops.agg(F.max("pos")).head()[0] - 5
    return ops.where(F.col("pos") <= changes.commit_cut(ops, head)).select("pos", "k", "op")


@query("select event_id as pos, user_id as k from events where event_id % 3 = 0 and event_id % 4 < 2")
def db_table_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.col("user_id").alias("k"),
        F.when(F.col("event_id") % 3 == 0, "shop").otherwise("SHOP").alias("db"),
        F.element_at(F.array(F.lit("users"), F.lit("items"), F.lit("other"), F.lit("marks")), (F.col("event_id") % 4 + 1).cast("int")).alias("tbl"),
        F.when(F.col("event_id") % 4 == 3, "mark").otherwise("insert").alias("kind"),
    )
    return changes.ours(rows, DB, ["users", "items"]).select("pos", "k")


# --- sinks ------------------------------------------------------------------------------------


@query("""select c_custkey, c_name, case when c_custkey % 5 = 0 then c_acctbal + 100 else c_acctbal end as c_acctbal from customer
  union all select c_custkey + 1000000, c_name, c_acctbal from customer where c_custkey % 5 = 1""")
def merge_upsert(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = target.where("c_custkey % 5 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new = target.where("c_custkey % 5 = 1").withColumn("c_custkey", F.col("c_custkey") + 1_000_000)
    return merge.upsert(target, changed.union(new), ("c_custkey",))


@query("select c_custkey from customer union select c_custkey + 7 from customer")
def merge_key_only(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey")
    return merge.upsert(target, target.select((F.col("c_custkey") + 7).alias("c_custkey")), ("c_custkey",))


def _users(spark) -> merge.VersionedTable:
    return merge.VersionedTable(spark, new_path(spark, "users"), K, {"value": "double", "props": "string"}, {"k": "long"})


@query(f"with {MOVED_SQL} {LATEST_SQL.format('moved')}")
def replay_idempotent(spark, sf_dir):
    ops, target = moved_ops(spark, sf_dir), _users(spark)
    half = ops.agg(F.max("pos")).head()[0] // 2
    for part in (ops.where(F.col("pos") <= half), ops, ops.where(F.col("pos") <= half)):
        target.apply(part)
    return target.read()


@query("select doc_id, lang, n_chars, source from documents")
def skip_columns(spark, sf_dir):
    return cells.convert_row(table(spark, sf_dir, "documents"), {}, skip=("text",), from_log=True)


# --- streams and state ------------------------------------------------------------------------


def _stream(spark, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a pattern, as the stream's path may be a single file only if it is one
    return from_events(spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{sf_dir}/events.parque[t]"))


@query(f"with {LOG_SQL} {LATEST_SQL.format('log')}")
def follow_stream(spark, sf_dir):
    target = _users(spark)
    follow(_stream(spark, sf_dir), target.apply, new_path(spark, "follow"), available_now=True).awaitTermination()
    return target.read()


@query(f"with {LOG_SQL} {LATEST_SQL.format('log')}")
def resume_from_pos(spark, sf_dir):
    """A run up to the last commit of the first half, and another from the position it left."""
    ops, target = log(spark, sf_dir), _users(spark)
    first = changes.commit_cut(ops, ops.agg(F.max("pos")).head()[0] // 2)
    target.apply(ops.where(F.col("pos") <= first), first)
    saved = target.manifest()["pos"]
    target.apply(ops.where(F.col("pos") > saved))
    return target.read()


@query("""select * from (values ('conversations', false, 'int:10|int:2', 'conv_id,turn', false), ('documents', true, 'int:7|bytes:cafe', 'doc_id,content_sha256', false),
  ('orders', true, 'int:999', 'o_orderkey', false), ('customer', false, null, 'c_custkey', false)) t(tbl, done, last_key, key_columns, all_done)""")
def progress_state(spark, sf_dir):
    """Progress of four tables, saved and loaded again."""
    folder = runs.folder(spark, "state")
    os.makedirs(folder)
    state = State(os.path.join(folder, "state.json"), "log.000003", 4711)
    state.tables = {
        "conversations": Progress(["conv_id", "turn"], False, [10, 2]),
        "documents": Progress(["doc_id", "content_sha256"], True, [7, b"\xca\xfe"]),
        "orders": Progress(["o_orderkey"], True, [999]),
        "customer": Progress(["c_custkey"]),
    }
    state.save()
    back = State.load(state.path)
    with open(state.path) as f:
        raw = json.load(f)
    assert (back.log_file, back.log_pos, back.tables) == (state.log_file, state.log_pos, state.tables)
    done = all(p.done for p in back.tables.values())
    rows = [(n, t["done"], None if t["last_key"] is None else "|".join(":".join(p) for p in t["last_key"]), ",".join(t["key_columns"]), done) for n, t in raw["tables"].items()]
    return spark.createDataFrame(rows, "tbl string, done boolean, last_key string, key_columns string, all_done boolean")


def queries() -> dict:
    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
