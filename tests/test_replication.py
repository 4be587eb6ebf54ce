import json
import random

import pytest
from pyspark.sql import functions as F

import tidemark.__main__ as cli
import tidemark.streaming.run as run
from tidemark.operators import changes, keys, merge, reconcile, rows, snapshot
from tidemark.operators.spec import SpecError, TableSpec
from tidemark.shared import new_path
from tidemark.sources import change_log
from tidemark.sources.config import State, parse_config
from tidemark.streaming.follow import Backfill, WindowInterrupted, await_mark, cut_to_commits, follow

K, PAYLOAD = ("k",), ["v"]
OPS = "k long, v long, op string, pos long, seq int"


def history(rng, n=150, keys_=12):
    """Operations with moves and deletes, and the state after each position."""
    ops, state, states = [], {}, {-1: {}}
    for pos in range(n):
        kind, k = rng.choice("uuudm"), rng.randrange(keys_)
        if kind == "d":
            ops.append((k, None, "d", pos, 1))
            state.pop(k, None)
        elif kind == "m" and k in state:
            new = rng.randrange(keys_)
            ops += [(k, None, "d", pos, 1), (new, pos, "u", pos, 2)]
            del state[k]
            state[new] = pos
        else:
            ops.append((k, pos, "u", pos, 2))
            state[k] = pos
        states[pos] = dict(state)
    return ops, states


def as_dict(df):
    return {r.k: r.v for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_both_reconciliations_reach_the_true_state(spark, seed):
    rng = random.Random(seed)
    ops, states = history(rng)
    low, high = sorted(rng.sample(range(10, 150), 2))
    at = rng.randint(low, high)
    log = spark.createDataFrame(ops, OPS)
    snap = spark.createDataFrame(list(states[at].items()) or [(0, 0)], "k long, v long")
    assert as_dict(reconcile.latest_state(log, K, PAYLOAD)) == states[149]
    assert as_dict(reconcile.backfill_chunk(snap, log, K, PAYLOAD, low, high)) == states[high]
    assert as_dict(reconcile.stamped_fold(snap, log, K, PAYLOAD, low, high)) == states[high]


def users(spark, **more):
    return merge.VersionedTable(spark, new_path(spark, "t"), K, {"v": "long"}, {"k": "long"}, **more)


def test_versioned_table_replays_and_keeps_tombstones(spark):
    ops, states = history(random.Random(9))
    log, table = spark.createDataFrame(ops, OPS), users(spark)
    assert as_dict(table.read()) == {}
    for a, b in ((0, 60), (0, 100), (40, 150), (0, 30)):
        table.apply(log.where((F.col("pos") >= a) & (F.col("pos") < b)), b - 1)
    assert as_dict(table.read()) == states[149] and table.manifest()["pos"] == 149
    gone = next(k for k in range(12) if k not in states[149]) if len(states[149]) < 12 else None
    if gone is not None:
        table.apply(spark.createDataFrame([(gone, 7, "u", 3, reconcile.LAST)], OPS))
        assert gone not in as_dict(table.read())
    version = table.manifest()["version"]
    table.apply(log.where("false"))
    assert table.manifest()["version"] == version
    table.purge()
    assert as_dict(table.read()) == states[149] and table.rows().where("op = 'd'").count() == 0


def test_writes_are_as_large_as_their_batches(spark):
    """Small batches leave old runs alone; alike ones are merged, so runs stay few; what no kept version names goes."""
    table, state = users(spark, fanout=3, keep=2), {}
    table.apply(spark.createDataFrame([(k, k, "u", 0, k) for k in range(400)], OPS))
    state |= {k: k for k in range(400)}
    first = table.manifest()["runs"][0]
    for i in range(1, 12):
        table.apply(spark.createDataFrame([(i, 1000 + i, "u", i, 2), (500 + i, i, "u", i, 2)], OPS), i)
        state |= {i: 1000 + i, 500 + i: i}
        found = table.manifest()
        assert found["runs"][0] == first and len(found["runs"]) <= 7 and found["pos"] == i
    assert as_dict(table.read()) == state
    fs, path = merge.file_system(spark, table.path)
    live = {r["folder"] for v in table._versions() for r in table._load(v)["runs"]}
    table.vacuum()
    assert len(table._versions()) == 2 and {s.getPath().getName() for s in fs.listStatus(path(table.path)) if s.getPath().getName().startswith("run-")} <= live
    table.purge()
    assert len(table.manifest()["runs"]) == 1 and as_dict(table.read()) == state


def test_a_second_writer_is_found_out(spark, monkeypatch):
    table = users(spark)
    table.apply(spark.createDataFrame([(1, 1, "u", 1, 2)], OPS), 1)
    old = table.manifest()
    table.apply(spark.createDataFrame([(1, 2, "u", 2, 2)], OPS), 2)
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(old)
    assert as_dict(table.read()) == {1: 2}


@pytest.mark.parametrize("seed", range(2))
def test_chunked_backfill_with_changes_in_every_window(spark, tmp_path, seed):
    """The source moves on at each read; stops and interrupted windows on the way lose nothing."""
    rng = random.Random(seed)
    ops, states = history(rng, 200, 25)
    log, table = spark.createDataFrame(ops, OPS).persist(), users(spark)
    now, fail = [20], [2]

    def mark():
        fail[0] -= 1
        if fail[0] == 0:
            return None
        now[0] = min(199, now[0] + rng.randint(0, 6))
        return now[0]

    def read(last, size):
        now[0] = min(199, now[0] + rng.randint(0, 4))
        return snapshot.next_chunk(spark.createDataFrame(list(states[now[0]].items()), "k long, v long"), K, last, size)

    def window(after, upto):
        return log.where((F.col("pos") > after) & (F.col("pos") <= upto))

    def make():
        state = State.load(path)

        def advance(upto):
            table.apply(window(-1 if state.log_pos is None else state.log_pos, upto), upto)
            state.log_pos = upto

        return Backfill(spec, read, window, mark, advance, table, state, size=6)

    spec, path = TableSpec("t", "t", K), str(tmp_path / "state.json")
    with pytest.raises(WindowInterrupted):
        make().run()
    stops = iter([False, True])
    make().run(lambda: next(stops))
    counts = make().run()
    state = State.load(path)
    assert state.tables["t"].done and counts.chunks >= 1
    assert as_dict(table.read()) == states[state.log_pos]
    table.apply(window(state.log_pos, 199))
    assert as_dict(table.read()) == states[199]
    assert make().run().chunks == 0


def test_waiting_for_a_mark_ends_when_the_log_is_silent():
    now, heads = [0.0], iter([1, 2, 3] + [3] * 50)
    step = lambda s: now.__setitem__(0, now[0] + s)
    assert await_mark(lambda: None, lambda: next(heads), 5, clock=lambda: now[0], sleep=step) is None and now[0] == 6
    found = iter([None, None, 42])
    assert await_mark(lambda: next(found), lambda: 1, 5, clock=lambda: now[0], sleep=step) == 42


def test_keyset_paging_reads_every_row_once_and_is_pushed_down(spark, tmp_path):
    rng = random.Random(1)
    rows = sorted({(rng.randrange(6), rng.choice("abc"), rng.randrange(4)) for _ in range(60)})
    spark.createDataFrame(rows, "a long, b string, c int").write.parquet(str(tmp_path / "t"))
    df, names, last, seen = spark.read.parquet(str(tmp_path / "t")), ("a", "b", "c"), None, []
    while True:
        chunk = snapshot.next_chunk(df, names, last, 7)
        if (last := snapshot.cursor(chunk, names)) is None:
            break
        seen += [tuple(r) for r in chunk.collect()]
    assert seen == rows
    plan = df.where(keys.after(names, [1, "b", 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(a,1)" in plan
    with pytest.raises(ValueError):
        keys.after(names, [1])


def test_assigned_chunks(spark):
    df = spark.range(95).select((F.col("id") * 7 % 95).alias("k")).repartition(5)
    got = snapshot.assign_chunks(df, K, 10)
    assert all(r.chunk_id == r.k // 10 for r in got.collect())
    assert sorted((r.chunk_id, r.last_key.k, r.n_rows) for r in snapshot.chunk_cursors(got, K).collect())[-1] == (9, 94, 5)
    assert snapshot.assign_chunks(df.limit(0), K, 10).count() == 0


def test_operations(spark):
    row = lambda k, v: None if k is None else (k, v)
    data = [(1, row(None, 0), row(1, 10)), (2, row(1, 10), row(1, 11)), (3, row(1, 11), row(2, 11)), (4, row(2, 11), row(None, 0))]
    log = spark.createDataFrame([(p, "update", "shop", "t", [(b, a)]) for p, b, a in data] + [(5, "commit", "shop", "t", None), (6, "insert", "other", "t", [(None, (9, 9))])],
                                "pos long, kind string, db string, tbl string, changes array<struct<before:struct<k:long,v:long>,after:struct<k:long,v:long>>>")
    got = changes.operations(changes.row_changes(changes.ours(log, "shop", ["t"])))
    assert [(r.pos, r.seq, r.op, r.row.k) for r in got.orderBy("pos", "seq").collect()] == [(1, 2, "u", 1), (2, 2, "u", 1), (3, 1, "d", 1), (3, 2, "u", 2), (4, 1, "d", 2)]


def test_short_rows_are_refused(spark):
    df = spark.createDataFrame([(["1", "2"],)], "cells array<string>")
    assert df.select(changes.cells_to_row(F.col("cells"), ["a", "b"]).alias("r")).head().r.b == "2"
    with pytest.raises(Exception, match="3 columns, cells: 2"):
        df.select(changes.cells_to_row(F.col("cells"), ["a", "b", "c"])).collect()


def test_ddl_is_refused(spark):
    log = spark.createDataFrame([(3, "ddl", "shop", "ALTER TABLE x ADD c INT"), (5, "ddl", "shop", "drop table y"), (1, "ddl", "other", "drop table z"), (7, "ddl", "shop", "\n\tTRUNCATE t")], "pos long, kind string, db string, statement string")
    with pytest.raises(changes.SchemaChange, match="ALTER TABLE x"):
        changes.refuse_ddl(log, "shop")
    with pytest.raises(changes.SchemaChange, match="drop table y"):
        changes.refuse_ddl(log, "shop", skip_to=3, strict=True)
    with pytest.raises(changes.SchemaChange, match="TRUNCATE"):
        changes.refuse_ddl(log, "shop", skip_to=5)
    changes.refuse_ddl(log, "shop", skip_to=7)


def test_table_numbers(spark):
    schema = "pos long, kind string, db string, tbl string, table_id long"
    log = spark.createDataFrame([(1, "map", "shop", "a", 7), (2, "insert", None, None, 7), (3, "map", "shop", "a", 7), (4, "update", None, None, 7), (5, "map", "shop", "b", 7), (6, "delete", None, None, 7), (7, "insert", "shop", "c", None), (8, "commit", None, None, None)], schema)
    got = {r.pos: (r.db, r.tbl) for r in changes.resolve_tables(log).collect()}
    assert [got[p] for p in (2, 4, 6, 7, 8)] == [("shop", "a"), ("shop", "a"), ("shop", "b"), ("shop", "c"), (None, None)]
    assert changes.table_names(log).count() == 2
    lost = spark.createDataFrame([(9, "insert", None, None, 8)], schema)
    with pytest.raises(Exception, match="no table has the number 8"):
        changes.resolve_tables(lost).collect()


def test_commits_and_marks(spark):
    log = spark.createDataFrame([(i, i % 4 == 3, "mark" if i == 2 else "insert", "shop", "wm" if i == 2 else "t", "ab" if i == 2 else None) for i in range(10)], "pos long, is_commit boolean, kind string, db string, tbl string, mark_id string")
    assert cut_to_commits(log).agg(F.max("pos")).head()[0] == 7 and changes.commit_cut(log, 6) == 3 and changes.commit_cut(log, 1) is None
    assert cut_to_commits(log, 1).count() == 0
    assert len({changes.new_mark() for _ in range(9)}) == 9 and len(changes.new_mark()) == 32
    assert [tuple(r) for r in changes.marks(log, "shop", "wm").collect()] == [("ab", 2)]


def write_log(folder, events, per=7):
    folder.mkdir(exist_ok=True)
    for k in range(0, len(events), per):
        (folder / f"{events[k]['pos']:012d}.jsonl").write_text("\n".join(json.dumps(e) for e in events[k : k + per]))


def as_events(ops, per=5):
    events = {}
    for k, v, op, pos, _ in ops:
        e = events.setdefault(pos, {"pos": pos, "db": "shop", "tbl": "t", "is_commit": pos % per == per - 1, "changes": []})
        e["changes"].append({"before": {"k": k, "v": 0}, "after": None} if op == "d" else {"before": None, "after": {"k": k, "v": v}})
    return [e | {"kind": "update"} for _, e in sorted(events.items())]


LONGS = TableSpec("t", "t", K).with_catalog([{"name": n, "data_type": "bigint", "charset": None, "nullable": False, "column_type": "bigint", "ordinal": i} for i, n in enumerate("kv")])


def test_log_source_streams_whole_transactions_and_resumes(spark, tmp_path):
    ops, states = history(random.Random(3), 83)
    events = as_events(ops)
    write_log(tmp_path / "log", events[:40])
    table, schema = users(spark), spark.createDataFrame([], "k long, v long").schema

    def apply(batch, pos):
        table.apply(rows.from_log(batch, LONGS, "shop", schema), pos)

    def go():
        follow(change_log.stream_log(spark, str(tmp_path / "log"), "earliest", 2), apply, str(tmp_path / "check"), available_now=True).awaitTermination()

    for upto in (40, 83):
        write_log(tmp_path / "log", events[:upto])
        for _ in range(4):
            go()
        done = max(e["pos"] for e in events[:upto] if e["is_commit"])
        assert as_dict(table.read()) == states[done] and table.manifest()["pos"] == done
    assert change_log.read_log(spark, str(tmp_path / "log")).count() == len(events)


def test_a_window_opens_only_the_files_that_hold_it(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "log")
    write_log(tmp_path / "log", as_events(history(random.Random(5), 100)[0]), per=10)  # files begin at 0, 10, 20, ...
    firsts = lambda low, high: [int(s.name.rsplit("/", 1)[1].split(".")[0]) for s in change_log.spans(folder, low, high)]
    assert firsts(-1, change_log.END) == list(range(0, 100, 10)) and firsts(34, 52) == [30, 40, 50] and firsts(39, 49) == [40] and firsts(99, 200) == [90] and firsts(9, 9) == [10][:0]
    assert [s.whole for s in change_log.spans(folder, 34, 52)] == [False, True, False]
    for low, high in ((-1, change_log.END), (34, 52), (39, 49), (98, 200), (5, 5)):
        assert sorted(r.pos for r in change_log.read_log(spark, folder, low, high).collect()) == [p for p in range(100) if low < p <= high]
    assert (change_log.head(folder), change_log.last_commit(folder)) == (99, 99)
    monkeypatch.setattr(change_log, "TAIL", 16)  # the end of a file is read in pieces
    monkeypatch.setattr(change_log, "BLOCK", 50)
    assert change_log.head(folder) == 99 and change_log.last_commit(folder, [change_log._files(folder)[2][1]]) == 29
    assert [change_log.position(x) for x in change_log.lines(folder, change_log.spans(folder, 34, 52)[0])] == list(range(35, 40))
    assert change_log.head(str(tmp_path / "none")) == -1
    with pytest.raises(ValueError, match="begins with its pos"):
        change_log.position(b'{"kind": "insert", "pos": 3}')


# --- whole runs -------------------------------------------------------------------------------------


def workspace(tmp_path, tables=("t",), **more):
    raw = {"mysql": {"user": "u", "db": "shop", "password_env": "P"}, "postgres": {"user": "u", "db": "d", "password_env": "P"},
           "tables": [{"mysql_table": t, "pg_table": f"public.{t}", "key_columns": ["k"]} for t in tables]} | more
    (tmp_path / "config.json").write_text(json.dumps(raw))
    return parse_config(raw)


def take_snapshot(spark, tmp_path, name, df, pos, **about):
    df.write.mode("overwrite").parquet(str(tmp_path / "source" / name))
    (tmp_path / "source" / f"{name}.json").write_text(json.dumps({"pos": pos} | about))


def state_of(spark, tmp_path, name="t", payload=None):
    return as_dict(merge.VersionedTable(spark, str(tmp_path / "target" / f"public.{name}"), K, payload or {"v": "long"}, {"k": "long"}).read())


def event(pos, tbl, before, after, **more):
    kind = "update" if before and after else "insert" if after else "delete"
    return {"pos": pos, "kind": kind, "db": "shop", "tbl": tbl, "is_commit": True, "changes": [{"before": before, "after": after}]} | more


@pytest.mark.parametrize("at", [0, 30, 59])
def test_a_run_from_a_snapshot_of_any_moment(spark, tmp_path, at):
    """The snapshot is stale by the events behind its position, and they win; those before it lose."""
    ops, states = history(random.Random(4), 60)
    write_log(tmp_path / "log", as_events(ops))
    take_snapshot(spark, tmp_path, "t", spark.createDataFrame(list(states[at].items()), "k long, v long"), at)
    config = workspace(tmp_path)
    counts = run.replicate(spark, str(tmp_path), config, once=True)
    assert state_of(spark, tmp_path) == states[59] and counts["t"].copied + counts["t"].superseded == len(states[at])
    state = State.load(str(tmp_path / "dblog_state.json"))
    assert state.tables["t"].done and state.log_pos == 59
    write_log(tmp_path / "log", [*as_events(ops), event(60, "t", None, {"k": 77, "v": 7})])
    run.replicate(spark, str(tmp_path), config, once=True)
    assert state_of(spark, tmp_path) == states[59] | {77: 7}


def test_a_snapshot_without_position_is_refused(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "k long, v long").write.parquet(str(tmp_path / "source" / "t"))
    with pytest.raises(SpecError, match="at which position"):
        run.replicate(spark, str(tmp_path), workspace(tmp_path), once=True)


def test_events_of_finished_tables_are_not_lost(spark, tmp_path):
    """Stop after the first table, let it change, go on with the second one."""
    write_log(tmp_path / "log", [event(0, "a", None, {"k": 1, "v": 0}), event(1, "b", None, {"k": 5, "v": 0})])
    for name, k in (("a", 1), ("b", 5)):
        take_snapshot(spark, tmp_path, name, spark.createDataFrame([(k, 0)], "k long, v long"), 1)
    config, asked = workspace(tmp_path, ("a", "b")), iter([False, False, True, True])
    run.replicate(spark, str(tmp_path), config, lambda: next(asked), once=True)
    state = State.load(str(tmp_path / "dblog_state.json"))
    assert state.tables["a"].done and not state.tables["b"].done
    write_log(tmp_path / "log2", [event(2, "a", {"k": 1, "v": 0}, {"k": 1, "v": 9}), event(3, "b", {"k": 5, "v": 0}, {"k": 6, "v": 1})])
    (tmp_path / "log2" / "000000000002.jsonl").rename(tmp_path / "log" / "000000000002.jsonl")
    run.replicate(spark, str(tmp_path), config, once=True)
    assert state_of(spark, tmp_path, "a") == {1: 9} and state_of(spark, tmp_path, "b") == {6: 1}


@pytest.mark.parametrize("statement", ["ALTER TABLE t ADD w INT", "\n\tDROP TABLE t"])
def test_a_schema_change_ends_the_run_in_either_phase(spark, tmp_path, statement):
    take_snapshot(spark, tmp_path, "t", spark.createDataFrame([(1, 0)], "k long, v long"), 0)
    first = [event(1, "t", None, {"k": 2, "v": 0})]
    ddl = {"pos": 2, "kind": "ddl", "db": "shop", "statement": statement, "is_commit": True}
    wider = event(3, "t", None, {"k": 3, "v": 0, "w": 1})
    write_log(tmp_path / "log", first)
    config = workspace(tmp_path)
    run.replicate(spark, str(tmp_path), config, once=True)
    write_log(tmp_path / "log", [*first, ddl, wider])
    with pytest.raises(Exception, match="changes the schema at position 2"):
        run.replicate(spark, str(tmp_path), config, once=True)
    with pytest.raises(Exception, match="2 columns, cells: 3"):  # told to go on, it meets the wider row
        run.replicate(spark, str(tmp_path), parse_config(json.loads((tmp_path / "config.json").read_text()) | {"skip_ddl_to": 2}), once=True)
    assert state_of(spark, tmp_path) == {1: 0, 2: 0}
    (tmp_path / "dblog_state.json").unlink()
    with pytest.raises(changes.SchemaChange):
        run.replicate(spark, str(tmp_path), config, once=True)


COLUMNS = [("k", "bigint", "bigint"), ("tags", "set", "set('red','blue')"), ("size", "enum", "enum('s','l')"), ("flags", "bit", "bit(12)"), ("n", "int", "int unsigned"), ("big", "bigint", "bigint unsigned"),
           ("price", "decimal", "decimal(10,2)"), ("doc", "json", "json"), ("raw", "blob", "blob"), ("day", "date", "date"), ("at", "timestamp", "timestamp"), ("span", "time", "time"), ("secret", "varchar", "varchar(9)")]


def test_both_routes_give_the_same_rows(spark, tmp_path):
    """A row per kind of column, once from the snapshot and once from the log, under another key."""
    df = spark.sql("""select 1L as k, 'red,blue' as tags, 'l' as size, X'0FFF' as flags, 4294967295L as n, cast('18446744073709551615' as decimal(20,0)) as big, cast('1.50' as decimal(10,2)) as price,
      '{"b": 1.50}' as doc, X'0001' as raw, date'2024-02-03' as day, timestamp'2024-02-03 04:05:06' as at, 93784000000L as span, 'x' as secret""")
    columns = [{"name": n, "data_type": t, "charset": "binary" if t == "blob" else None, "nullable": n != "k", "column_type": c, "ordinal": i} for i, (n, t, c) in enumerate(COLUMNS)]
    take_snapshot(spark, tmp_path, "t", df, 0, columns=columns)
    cells = {"tags": 3, "size": 2, "flags": "D/8=", "n": -1, "big": -1, "price": "1.50", "doc": '{"b": 1.50}', "raw": "AAE=", "day": "2024-02-03", "at": "2024-02-03T05:05:06+01:00", "span": 93784000000, "secret": "y"}
    write_log(tmp_path / "log", [event(1, "t", None, {"k": 2} | cells), event(2, "t", None, {"k": 3} | dict.fromkeys(cells))])
    config = workspace(tmp_path)
    config = parse_config(json.loads((tmp_path / "config.json").read_text()) | {"tables": [{"mysql_table": "t", "pg_table": "public.t", "key_columns": ["k"], "skip_columns": ["secret"]}]})
    work = run.Replication(spark, str(tmp_path), config)
    work.open()
    work.backfill(lambda: False)
    got = {r.k: r.asDict() for r in work.tables["t"].target.read().collect()}
    one, two, none = ({c: v for c, v in got[k].items() if c != "k"} for k in (1, 2, 3))
    assert one == two and one["tags"] == "blue,red" and one["flags"] == 4095 and one["n"] == 4294967295 and one["price"] == "1.50" and one["span"] == "1 day, 2:03:04" and str(one["at"]) == "2024-02-03 04:05:06"
    assert "secret" not in one and set(none.values()) == {None}


def test_settings_and_null_keys_are_checked_at_the_start(spark, tmp_path):
    take_snapshot(spark, tmp_path, "t", spark.createDataFrame([(None, 0), (1, 1)], "k long, v long"), 0)
    with pytest.raises(SpecError, match="null in the key"):
        run.replicate(spark, str(tmp_path), workspace(tmp_path), once=True)
    (tmp_path / "source" / "settings.json").write_text(json.dumps({"binlog_format": "STATEMENT"}))
    with pytest.raises(SpecError, match="binlog_format"):
        run.replicate(spark, str(tmp_path), workspace(tmp_path), once=True)
    (tmp_path / "source" / "settings.json").unlink()
    take_snapshot(spark, tmp_path, "t", spark.createDataFrame([(1, 0)], "k long, pos long"), 0)
    with pytest.raises(SpecError, match="stamp"):
        run.replicate(spark, str(tmp_path), workspace(tmp_path), once=True)


def test_an_unfinished_window_leaves_its_table_and_tries_the_next(spark, tmp_path):
    """The snapshot of a is newer than the log; b is copied, and the log is not followed yet."""
    write_log(tmp_path / "log", [event(1, "b", None, {"k": 6, "v": 0})])
    take_snapshot(spark, tmp_path, "a", spark.createDataFrame([(1, 0)], "k long, v long"), 9)
    take_snapshot(spark, tmp_path, "b", spark.createDataFrame([(5, 0)], "k long, v long"), 0)
    counts = run.replicate(spark, str(tmp_path), workspace(tmp_path, ("a", "b")), once=True)
    assert set(counts) == {"b"} and state_of(spark, tmp_path, "b") == {5: 0, 6: 0} and not (tmp_path / "checkpoints").exists()
    write_log(tmp_path / "log", [event(1, "b", None, {"k": 6, "v": 0}), event(9, "a", None, {"k": 1, "v": 0}), event(10, "a", {"k": 1, "v": 0}, None)])
    run.replicate(spark, str(tmp_path), workspace(tmp_path, ("a", "b")), once=True)
    assert state_of(spark, tmp_path, "a") == {}


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    take_snapshot(spark, tmp_path, "t", spark.createDataFrame([(1, 0)], "k long, v long"), 0)
    write_log(tmp_path / "log", [event(1, "t", None, {"k": 2, "v": 0})])
    workspace(tmp_path)
    asked = iter([False] * 4 + [True] * 100)  # a signal while the log is followed
    monkeypatch.setattr(cli, "Stop", lambda: type("S", (), {"asked": property(lambda self: next(asked))})())
    assert cli.main([str(tmp_path)]) == 0 and state_of(spark, tmp_path) == {1: 0, 2: 0}
    assert cli.main([]) == 1 and cli.main([str(tmp_path / "absent")]) == 2
    (tmp_path / "source" / "t.json").unlink()
    assert cli.main([str(tmp_path)]) == 2

    def forced(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(run, "replicate", forced)
    assert cli.main([str(tmp_path)]) == 130


def test_upsert_and_delete(spark):
    target = spark.createDataFrame([(1, 1), (2, 2)], "k long, v long")
    assert as_dict(merge.upsert(target, spark.createDataFrame([(2, 9), (3, 3)], "k long, v long"), K)) == {1: 1, 2: 9, 3: 3}
    assert as_dict(merge.delete(target, spark.createDataFrame([(2, 0), (7, 0)], "k long, v long"), K)) == {1: 1}
