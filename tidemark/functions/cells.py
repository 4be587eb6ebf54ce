"""Canonical cell values as Column expressions.

A row may arrive by snapshot or by change log, and the two encode some types
differently.  Each builder gives one form for both; ``from_log`` picks the
conversions that only the log needs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.spec import ColumnSpec

MICROS_PER_DAY = 86_400_000_000
_WIDTHS = {"tinyint": 8, "smallint": 16, "mediumint": 24, "int": 32}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def to_text(c: Column) -> Column:
    """Bytes as UTF-8 text, with U+FFFD for what is not UTF-8."""
    return F.make_valid_utf8(c.cast("string"))


def to_bytes(c: Column, kind: T.DataType) -> Column:
    """Text as UTF-8 bytes; bytes stay.  Anything else would lose information."""
    if isinstance(kind, T.BinaryType):
        return c
    if isinstance(kind, T.StringType):
        return F.encode(c, "UTF-8")
    raise TypeError(f"{kind.simpleString()} cannot become bytes without loss")


def bit_to_int(c: Column, kind: T.DataType, bits: int = 64) -> Column:
    """A bit field as an integer: booleans, big-endian bytes, or bits from the highest; wider than 63 bits as a decimal."""
    if isinstance(kind, T.BooleanType):
        return c.cast("long")
    if isinstance(kind, T.BinaryType):
        whole = F.conv(F.hex(c), 16, 10)
        return whole.cast("long") if bits < 64 else whole.cast("decimal(20,0)")
    if isinstance(kind, T.ArrayType):
        digits = F.array_join(F.transform(c, lambda b: b.cast("int").cast("string")), "")
        whole = F.conv(digits, 2, 10)
        return whole.cast("long") if bits < 64 else whole.cast("decimal(20,0)")
    return c.cast("long") if bits < 64 else c.cast("decimal(20,0)")


def signedness(c: Column, column: ColumnSpec) -> Column:
    """The log's fixed-width integers read as the column's own signedness."""
    if column.source_type in _WIDTHS and column.unsigned:
        return c.cast("long").bitwiseAND((1 << _WIDTHS[column.source_type]) - 1)
    if column.source_type == "bigint" and column.unsigned:
        wide = c.cast("decimal(20,0)")
        return F.when(c < 0, wide + F.lit(Decimal(1 << 64))).otherwise(wide).cast("decimal(20,0)")
    if column.source_type == "tinyint":
        return F.when(c > 127, c - 256).otherwise(c).cast("byte")
    return c


def set_to_text(c: Column, kind: T.DataType, members: tuple[str, ...]) -> Column:
    """Members of a set in byte order, from text, from a bit mask, or from a list."""
    if isinstance(kind, T.BinaryType):
        c, kind = to_text(c), T.StringType()
    if isinstance(kind, _WHOLE):
        mask = c.cast("long")
        chosen = [F.when(F.shiftright(mask, i).bitwiseAND(1) == 1, F.lit(m)) for i, m in enumerate(members[:64])]
        items = F.array_compact(F.array(*chosen)) if chosen else F.array().cast("array<string>")
        return F.when(c.isNotNull(), F.array_join(F.array_sort(items), ","))
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.array_sort(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("")))), ",")
    if isinstance(kind, T.StringType):
        return F.when(c == "", "").otherwise(F.array_join(F.array_sort(F.split(c, ",")), ","))
    return c.cast("string")


def enum_to_text(c: Column, kind: T.DataType, members: tuple[str, ...]) -> Column:
    """The label of an enumeration: text stays, numbers count from 1, 0 is empty, others are their digits."""
    if isinstance(kind, T.BinaryType):
        return to_text(c)
    if isinstance(kind, _WHOLE):
        labels = F.array(*[F.lit(m) for m in members]) if members else F.array().cast("array<string>")
        return F.when(c == 0, "").otherwise(F.coalesce(F.get(labels, (c - 1).cast("int")), c.cast("string")))
    return c.cast("string")


def decimal_to_text(c: Column) -> Column:
    """Digits with the scale kept; text, which may hold more than 38 digits, stays."""
    return c.cast("string")


def time_to_text(micros: Column) -> Column:
    """A duration in microseconds as ``[N day[s], ]h:mm:ss[.ffffff]``; negative ones have negative days."""
    rest = F.pmod(micros, F.lit(MICROS_PER_DAY))
    days = ((micros - rest) / MICROS_PER_DAY).cast("long")
    second = F.floor(rest / 1_000_000)
    fraction = F.pmod(rest, F.lit(1_000_000))

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    clock = F.concat_ws(":", F.floor(second / 3600).cast("string"), two(F.floor(second / 60) % 60), two(second % 60))
    clock = F.when(fraction == 0, clock).otherwise(F.concat(clock, F.lit("."), F.lpad(fraction.cast("string"), 6, "0")))
    name = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), name, clock))


def canonical(c: Column, kind: T.DataType, column: ColumnSpec, from_log: bool) -> Column:
    """The one form of a cell that identity and writes are built on."""
    if from_log and isinstance(kind, _WHOLE):
        c = signedness(c, column)
    if column.kind == "binary":
        return to_bytes(c, kind)
    if column.kind == "bit":
        return bit_to_int(c, kind, column.bits)
    if column.kind == "json":
        return to_text(c) if isinstance(kind, T.BinaryType) else c if isinstance(kind, T.StringType) else F.to_json(c)
    if column.kind == "set":
        return set_to_text(c, kind, column.members)
    if column.kind == "enum":
        return enum_to_text(c, kind, column.members)
    if column.kind == "decimal":
        return decimal_to_text(c)
    if column.source_type == "date":
        return c.cast("date")
    if column.source_type == "timestamp" and isinstance(kind, T.TimestampType):
        return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")
    return c


def for_target(c: Column, kind: T.DataType, column: ColumnSpec, from_log: bool) -> Column:
    """A canonical cell as the target takes it."""
    found = canonical(c, kind, column, from_log)
    if column.kind != "plain":
        return found
    if isinstance(kind, T.BinaryType):
        return to_text(found)
    if column.source_type == "time" and isinstance(kind, _WHOLE):
        return time_to_text(c.cast("long"))
    if isinstance(kind, T.DayTimeIntervalType):
        micros = (F.extract(F.lit("DAY"), c).cast("long") * 24 + F.extract(F.lit("HOUR"), c)) * 3_600_000_000 + F.extract(F.lit("MINUTE"), c) * 60_000_000
        return time_to_text((micros + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")).cast("long"))
    return found


def convert_row(df, columns: dict[str, ColumnSpec], skip: tuple[str, ...] = (), from_log: bool = False):
    """All columns but ``skip``, canonical and ready to write, in the order of their names."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[for_target(F.col(n), kinds[n], columns.get(n, ColumnSpec(n)), from_log).alias(n) for n in sorted(kinds) if n not in skip])
