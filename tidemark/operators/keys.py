"""Row identity: every part of a key is a (type tag, text) pair, so that 5 and "5" differ.

The text of a floating-point number is its 64 bits as a whole number, since no two
languages agree on its digits; both zeros are one value, and so are all NaN.
"""

from __future__ import annotations

import math
import struct
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cells import canonical, to_text
from tidemark.operators.spec import ColumnSpec

IDENTITY = "array<struct<type:string,text:string>>"


def _tagged(c: Column, kind: T.DataType) -> tuple[str, Column]:
    if isinstance(kind, T.BinaryType):
        return "bytes", F.lower(F.hex(c))
    if isinstance(kind, T.BooleanType):
        return "bool", c.cast("int").cast("string")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) or isinstance(kind, T.DecimalType) and kind.scale == 0:
        return "int", c.cast("string")
    if isinstance(kind, T.DecimalType):
        return "decimal", c.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(kind, T.DateType):
        return "date", F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # a float key is rare; this is the one way to its bits without Python
        return "float", F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), c.cast("double") + F.lit(0.0))
    return "str", c.cast("string")


def encode(c: Column, kind: T.DataType, column: ColumnSpec | None = None, from_log: bool = False) -> Column:
    """A cell as struct<type, text>."""
    column = column or ColumnSpec("")
    found = canonical(c, kind, column, from_log)
    if column.kind in ("set", "enum", "json", "decimal"):
        tag, text = "str", found.cast("string")
    elif column.kind == "bit":
        tag, text = "int", found.cast("string")
    elif column.kind == "binary":
        tag, text = "bytes", F.lower(F.hex(found))
    elif isinstance(kind, T.BinaryType):
        tag, text = "str", to_text(found)
    else:
        tag, text = _tagged(found, kind)
    return F.when(c.isNull(), F.struct(F.lit("null").alias("type"), F.lit("").alias("text"))).otherwise(F.struct(F.lit(tag).alias("type"), text.alias("text")))


def row_identity(df: DataFrame, keys: tuple[str, ...], columns: dict[str, ColumnSpec] | None = None, from_log: bool = False, prefix: str = "") -> Column:
    """The identity of a row as array<struct<type, text>>, in the order of ``keys``."""
    kinds = {f.name: f.dataType for f in df.schema}
    return F.array(*[encode(F.col(prefix + k), kinds[prefix + k], (columns or {}).get(k), from_log) for k in keys])


def encode_value(value) -> tuple[str, str]:
    """The same pair for a value on the driver."""
    if value is None:
        return "null", ""
    if isinstance(value, (bytes, bytearray)):
        return "bytes", bytes(value).hex()
    if isinstance(value, bool):
        return "bool", str(int(value))
    if isinstance(value, int):
        return "int", str(value)
    if isinstance(value, Decimal):
        return ("int", str(int(value))) if value.as_tuple().exponent == 0 else ("decimal", format(value, "f"))
    if isinstance(value, datetime):
        return "datetime", value.isoformat(timespec="microseconds")
    if isinstance(value, date):
        return "date", value.isoformat()
    if isinstance(value, float):
        return "float", str(struct.unpack(">q", struct.pack(">d", math.nan if math.isnan(value) else value + 0.0))[0])
    return "str", str(value)


def _float(text: str) -> float:
    return struct.unpack(">d", struct.pack(">q", int(text)))[0]


def decode_value(tag: str, text: str):
    """The value of a pair; an unknown tag gives the text."""
    if tag == "null":
        return None
    decoders = {"bytes": bytes.fromhex, "bool": lambda t: t == "1", "int": int, "datetime": datetime.fromisoformat, "date": date.fromisoformat, "float": _float}
    if tag == "decimal":
        try:
            return Decimal(text)
        except ArithmeticError:
            return text
    return decoders.get(tag, str)(text)


def decode(part: Column, kind: str) -> Column:
    """A pair back to a cell of the Spark type ``kind``."""
    text = part["text"]
    value = F.unhex(text) if kind == "binary" else (text == "1") if kind == "boolean" else text.try_cast(kind)
    if kind in ("float", "double"):
        value = F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), text.try_cast("bigint")).try_cast(kind)
    return F.when(part["type"] != "null", value)


def after(keys: tuple[str, ...], values: list) -> Column:
    """Rows behind ``values`` in the lexicographic order of ``keys``.

    Written as ``a > x or (a = x and b > y)``, a form that scans can push down; a
    comparison of structs is not pushed.
    """
    if len(keys) != len(values):
        raise ValueError("a value for each key")
    found = None
    for k in reversed(range(len(keys))):
        beyond = F.col(keys[k]) > F.lit(values[k])
        found = beyond if found is None else beyond | ((F.col(keys[k]) == F.lit(values[k])) & found)
    return found
