from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cells
from tidemark.operators import keys
from tidemark.operators.spec import ColumnSpec, type_members

BYTE, INT, LONG, TEXT, BYTES = T.ByteType(), T.IntegerType(), T.LongType(), T.StringType(), T.BinaryType()


def one(spark, value, kind, f):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", kind)]))
    return df.select(f(F.col("c")).alias("x")).head().x


def spec(kind="plain", source="", unsigned=False, members=()):
    return ColumnSpec("c", kind, source, unsigned, members)


SET, ENUM = spec("set", "set", members=("b", "a", "c")), spec("enum", "enum", members=("one", "two"))
VECTORS = [
    (-1, BYTE, spec(source="tinyint", unsigned=True), True, 255),
    (255, T.ShortType(), spec(source="tinyint"), True, -1),
    (-1, T.ShortType(), spec(source="smallint", unsigned=True), True, 65535),
    (-1, INT, spec(source="mediumint", unsigned=True), True, 16777215),
    (-1, INT, spec(source="int", unsigned=True), True, 4294967295),
    (-1, LONG, spec(source="bigint", unsigned=True), True, Decimal(18446744073709551615)),
    (255, T.ShortType(), spec(source="tinyint", unsigned=True), False, 255),
    (b"\0\5", BYTES, spec("bit", "bit"), True, 5),
    ([True, False, True], T.ArrayType(T.BooleanType()), spec("bit", "bit"), True, 5),
    (b"\xff" * 8, BYTES, spec("bit", "bit"), True, Decimal(18446744073709551615)),
    (True, T.BooleanType(), spec("bit", "bit"), False, 1),
    ("b,a", TEXT, SET, False, "a,b"),
    (b"b,a", BYTES, SET, False, "a,b"),
    (3, LONG, SET, True, "a,b"),
    (0, LONG, SET, True, ""),
    ("", TEXT, SET, False, ""),
    (8, LONG, SET, True, ""),
    (["b", "a"], T.ArrayType(TEXT), SET, True, "a,b"),
    (1, INT, ENUM, True, "one"),
    (2, INT, ENUM, True, "two"),
    (0, INT, ENUM, True, ""),
    (7, INT, ENUM, True, "7"),
    ("one", TEXT, ENUM, False, "one"),
    (Decimal("10.50"), T.DecimalType(10, 2), spec("decimal", "decimal"), True, "10.50"),
    ("1" * 50 + ".5", TEXT, spec("decimal", "decimal"), True, "1" * 50 + ".5"),
    ('{"b":1, "a":2}', TEXT, spec("json", "json"), False, '{"b":1, "a":2}'),
    ("a", TEXT, spec("binary", "blob"), True, b"a"),
    (datetime(2024, 1, 2, 3), T.TimestampNTZType(), spec(source="date"), True, date(2024, 1, 2)),
    (timedelta(hours=50), T.DayTimeIntervalType(), spec(source="time"), True, "2 days, 2:00:00"),
    (b"\xffa", BYTES, spec(), True, "�a"),
]


@pytest.mark.parametrize("value, kind, column, from_log, want", VECTORS)
def test_vectors(spark, value, kind, column, from_log, want):
    assert one(spark, value, kind, lambda c: cells.for_target(c, kind, column, from_log)) == want
    assert one(spark, None, kind, lambda c: cells.for_target(c, kind, column, from_log)) is None


def test_bytes_refuse_numbers(spark):
    with pytest.raises(TypeError):
        cells.canonical(F.lit(1), INT, spec("binary", "blob"), True)


def test_timestamp_loses_its_zone(spark):
    df = spark.sql("select timestamp'2024-01-01T02:00:00+02:00' as c")
    got = df.select(cells.canonical(F.col("c"), T.TimestampType(), spec(source="timestamp"), True).alias("x")).head().x
    assert got == datetime(2024, 1, 1)


@given(st.lists(st.integers(-838 * 3600 * 10**6, 838 * 3600 * 10**6), min_size=1, max_size=200))
@settings(max_examples=5, deadline=None)
def test_durations_equal_python(spark, values):
    values += [0, -1_000_000, 86_400_000_000, 93_600_000_001, -86_400_000_000, -1]
    df = spark.createDataFrame([(v,) for v in values], "us long")
    assert all(r.x == str(timedelta(microseconds=r.us)) for r in df.select("us", cells.time_to_text(F.col("us")).alias("x")).collect())


@pytest.mark.parametrize("text, want", [
    ("set('a','b')", ["a", "b"]), ("enum('it''s')", ["it's"]), (r"enum('a\'b')", ["a'b"]), (r"set('x\ny','\q')", ["x\ny", "q"]),
    ("int", []), ("int(11)", []), ("enum('')", [""]), ("enum('a,b',')')", ["a,b", ")"]), ("enum('a", []),
])
def test_members(text, want):
    assert type_members(text) == want


def test_row_order_and_skipping(spark):
    df = spark.createDataFrame([(1, "x", b"y")], "z int, a string, m binary")
    got = cells.convert_row(df, {"m": ColumnSpec("m", "binary", "blob")}, skip=("a",), from_log=True)
    assert got.columns == ["m", "z"] and got.head().m == b"y"


IDENTITIES = [
    (None, INT, spec(), ("null", "")), (b"\xca\xfe", BYTES, spec("binary", "blob"), ("bytes", "cafe")), (5, INT, spec(), ("int", "5")), (5, LONG, spec(), ("int", "5")),
    ("5", TEXT, spec(), ("str", "5")), (date(2024, 1, 2), T.DateType(), spec(), ("date", "2024-01-02")), (True, T.BooleanType(), spec(), ("bool", "1")),
    (b"\5", BYTES, spec("bit", "bit"), ("int", "5")), (Decimal("1.50"), T.DecimalType(5, 2), spec("decimal", "decimal"), ("str", "1.50")), (b"ab", BYTES, spec(), ("str", "ab")),
    (datetime(2024, 1, 2, 3, 4, 5, 6), T.TimestampNTZType(), spec(), ("datetime", "2024-01-02T03:04:05.000006")), (2.5, T.DoubleType(), spec(), ("float", "4612811918334230528")),
]


@pytest.mark.parametrize("value, kind, column, want", IDENTITIES)
def test_identity(spark, value, kind, column, want):
    assert tuple(one(spark, value, kind, lambda c: keys.encode(c, kind, column))) == want


def test_routes_agree_on_identity(spark):
    column = spec(source="tinyint", unsigned=True)
    log = one(spark, -1, BYTE, lambda c: keys.encode(c, BYTE, column, True))
    assert log == one(spark, 255, INT, lambda c: keys.encode(c, INT, column, False)) == ("int", "255")


@given(st.one_of(st.none(), st.booleans(), st.integers(-(2**70), 2**70), st.binary(max_size=9), st.dates(), st.datetimes(), st.text(max_size=9), st.floats(allow_nan=False), st.decimals(allow_nan=False, allow_infinity=False)))
def test_driver_values_round_trip(value):
    assert keys.decode_value(*keys.encode_value(value)) == value


@given(st.lists(st.tuples(st.floats() | st.sampled_from([0.0, -0.0, 1e10, 1e-7, 5e-324, 2.0**-44]), st.integers(-(2**63), 2**63 - 1), st.decimals(-(10**20), 10**20, places=3), st.integers(0, 2**64 - 1), st.datetimes(), st.binary(max_size=5), st.booleans()), min_size=1, max_size=30))
@settings(max_examples=10, deadline=None)
def test_columns_and_driver_give_the_same_pair(spark, found):
    kinds = "f double, i long, d decimal(30,3), u decimal(20,0), t timestamp_ntz, b binary, o boolean"
    df = spark.createDataFrame([(f, i, d, Decimal(u), t.replace(year=max(t.year, 1000)), bytes(b), o) for f, i, d, u, t, b, o in found], kinds)
    binary = {"b": ColumnSpec("b", "binary", "blob")}
    rows = df.select("*", keys.row_identity(df, tuple(df.columns), binary).alias("id")).collect()
    for r in rows:
        assert [tuple(p) for p in r.id] == [keys.encode_value(v) for v in r[:-1]]
    back = df.select(keys.row_identity(df, ("f",)).alias("id"), "f").select(keys.decode(F.col("id")[0], "double").alias("x"), "f").collect()
    assert all(r.x == r.f or r.x != r.x and r.f != r.f for r in back)


def test_unknown_tags_give_text():
    assert keys.decode_value("decimal", "x") == "x" and keys.decode_value("other", "y") == "y" and keys.decode_value("int", "18446744073709551615") == 2**64 - 1
