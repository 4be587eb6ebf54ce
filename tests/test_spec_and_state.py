import json
import os

import pytest

from tidemark.operators import spec as s
from tidemark.sources import config as c
from tidemark.sources.database import chunk_query, merge_sql

MINIMAL = {
    "mysql": {"user": "u", "db": "shop", "password_env": "SRC_PW"},
    "postgres": {"user": "u", "db": "shop", "password_env": "DST_PW", "port": 5433},
    "tables": [{"mysql_table": "users", "pg_table": "public.users", "key_columns": ["id"]}],
}
CATALOG = [
    {"name": "id", "data_type": "bigint", "charset": None, "nullable": False, "column_type": "bigint unsigned", "ordinal": 1},
    {"name": "kinds", "data_type": "set", "charset": "utf8mb4", "nullable": True, "column_type": "set('a','b')", "ordinal": 3},
    {"name": "raw", "data_type": "varchar", "charset": "binary", "nullable": True, "column_type": "varchar(3)", "ordinal": 2},
    {"name": "at", "data_type": "point", "charset": None, "nullable": True, "column_type": "point", "ordinal": 4},
]


def test_config_defaults_and_errors(monkeypatch):
    found = c.parse_config(MINIMAL)
    assert (found.chunk_size, found.watermark_table, found.watermark_timeout_seconds, found.state_file, found.server_id, found.heartbeat_seconds) == (1000, "dblog_watermarks", 120, "dblog_state.json", 100, 10)
    assert found.source.host == "127.0.0.1" and found.source.port_or(3306) == 3306 and found.target.port_or(5432) == 5433
    with pytest.raises(s.SpecError, match="SRC_PW"):
        found.source.password()
    monkeypatch.setenv("SRC_PW", "")
    assert found.source.password() == ""
    for name in MINIMAL:
        with pytest.raises(s.SpecError):
            c.parse_config({k: v for k, v in MINIMAL.items() if k != name})
    with pytest.raises(s.SpecError, match="password_env"):
        c.parse_config(MINIMAL | {"mysql": {"user": "u", "db": "d"}})


def test_tables():
    with pytest.raises(s.SpecError, match="empty"):
        s.TableSpec("t", "t", ())
    with pytest.raises(s.SpecError, match="skipped"):
        s.TableSpec("t", "t", ("a", "b"), ("b",))
    t = s.TableSpec("t", "p.t", ("id",)).with_catalog(CATALOG)
    assert [(x.name, x.kind, x.unsigned, x.members) for x in t.columns] == [("id", "plain", True, ()), ("raw", "binary", False, ()), ("kinds", "set", False, ("a", "b")), ("at", "plain", False, ())]
    assert s.ColumnSpec.from_catalog("f", "bit", None, "bit(12)").bits == 12 and t.payload() == ["raw", "kinds", "at"]
    for bad, message in (([], "no such table"), ([CATALOG[0] | {"nullable": True}], "null"), ([CATALOG[1]], "no column id")):
        with pytest.raises(s.SpecError, match=message):
            s.TableSpec("t", "p.t", ("id",)).with_catalog(bad)


@pytest.mark.parametrize("name", s.REQUIRED_SETTINGS)
def test_settings(name):
    s.check_settings({k: v.lower() for k, v in s.REQUIRED_SETTINGS.items()})
    with pytest.raises(s.SpecError, match=name):
        s.check_settings(s.REQUIRED_SETTINGS | {name: "other"})


def test_statements():
    t = s.TableSpec("t", "p.t", ("id",), (), (s.ColumnSpec("id"), s.ColumnSpec("d", "decimal"), s.ColumnSpec("j", "json")))
    gone, new = merge_sql(t, "p.s", postgres=True)
    assert gone == 'DELETE FROM "p"."t" WHERE EXISTS (SELECT 1 FROM "p"."s" s WHERE s."id" = "p"."t"."id" AND s.op = \'d\')'
    assert new == 'INSERT INTO "p"."t" ("d", "id", "j") SELECT s."d", s."id", s."j"::jsonb FROM "p"."s" s WHERE s.op = \'u\' ON CONFLICT ("id") DO UPDATE SET "d" = EXCLUDED."d", "j" = EXCLUDED."j"'
    assert merge_sql(s.TableSpec("t", "t", ("id",), (), (s.ColumnSpec("id"),)), "s", True)[1].endswith('ON CONFLICT ("id") DO NOTHING')
    two = s.TableSpec("t", "t", ("a", "b"), ("c",), tuple(map(s.ColumnSpec, "abc")))
    assert chunk_query(two, [1, "x'\\"], 9, "jdbc:mysql://h/d") == "SELECT `a`, `b` FROM `t` WHERE (`a` > 1) OR (`a` = 1 AND `b` > 'x''\\\\') ORDER BY `a`, `b` LIMIT 9"
    assert chunk_query(two, None, 9, "jdbc:derby:x") == 'SELECT "a", "b" FROM "t" ORDER BY "a", "b" FETCH FIRST 9 ROWS ONLY'
    assert s.quote_target('a.b"c') == '"a"."b""c"' and s.quote_source("a.b`c") == "`a.b``c`"


def test_key_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (1, 2)], "a int, b int")
    s.check_keys(df, ("a",))
    with pytest.raises(s.SpecError, match="null"):
        s.check_keys(df, ("a", "b"))
    with pytest.raises(s.SpecError, match="unique"):
        s.check_unique(df, ("a", "b"))


def test_state_round_trip_and_crash(tmp_path, monkeypatch):
    path = str(tmp_path / "state.json")
    state = c.State(path, "log.7", 99, {"users": c.Progress(["id"], False, [42]), "docs": c.Progress(["id", "h"], True, [1, b"\xca"])})
    state.save()
    assert json.loads(open(path).read())["tables"]["users"] == {"done": False, "last_key": [["int", "42"]], "key_columns": ["id"]}
    assert c.State.load(path) == state
    users = s.TableSpec("users", "users", ("uuid",))
    with pytest.raises(s.SpecError, match="begun with the key id"):
        state.progress(users)
    state.log_pos = 100
    monkeypatch.setattr(os, "replace", lambda *_: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        state.save()
    assert c.State.load(path).log_pos == 99
    assert not state.all_done([s.TableSpec("docs", "d", ("id", "h")), s.TableSpec("new", "n", ("k",))])


def test_dotenv(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# c\n\nexport A1='x y'\nB1=\"z\"\nC1 = plain \nnothing\n=bad\nD1=new\n")
    inner = tmp_path / "a" / "b"
    inner.mkdir(parents=True)
    for name in ("A1", "B1", "C1"):
        monkeypatch.delenv(name, raising=False)
    monkeypatch.setenv("D1", "old")
    assert c.load_dotenv(str(inner)) == tmp_path / ".env"
    assert [os.environ.pop(n) for n in ("A1", "B1", "C1")] == ["x y", "z", "plain"] and os.environ["D1"] == "old"
