"""Tables, columns and the checks made before a run."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Source types whose cells are bytes.
BINARY_TYPES = {"binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob", "geometry"}
#: Settings that a source must have for full row images in its change log.
REQUIRED_SETTINGS = {"binlog_format": "ROW", "binlog_row_image": "FULL", "binlog_row_metadata": "FULL", "binlog_row_value_options": ""}

_QUOTED = re.compile(r"'((?:[^'\\]|\\.|'')*)'", re.S)
_ESCAPE = re.compile(r"\\(.)|''", re.S)
_BITS = re.compile(r"bit\((\d+)\)", re.I)
#: What a letter behind a backslash stands for.
_CONTROL = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}


class SpecError(ValueError):
    """A table, its configuration or its source is not fit for replication."""


def type_members(column_type: str) -> list[str]:
    """The members of ``set('a','b')`` or ``enum('a','b')``; none for other types."""
    start, end = column_type.find("("), column_type.rfind(")")
    if start < 0 or end <= start:
        return []

    def plain(m: re.Match) -> str:
        return "'" if m[1] is None else _CONTROL.get(m[1], m[1])

    return [_ESCAPE.sub(plain, body) for body in _QUOTED.findall(column_type[start + 1 : end])]


@dataclass(frozen=True)
class ColumnSpec:
    """What a column is at the source."""

    name: str
    kind: str = "plain"
    source_type: str = ""
    unsigned: bool = False
    members: tuple[str, ...] = ()
    bits: int = 64

    @classmethod
    def from_catalog(cls, name: str, data_type: str, charset: str | None, column_type: str) -> ColumnSpec:
        """From a row of the source's column catalogue."""
        if data_type in ("json", "bit", "set", "enum", "decimal"):
            kind = data_type
        else:
            kind = "binary" if data_type in BINARY_TYPES or charset == "binary" else "plain"
        width = _BITS.search(column_type)
        members = tuple(type_members(column_type)) if kind in ("set", "enum") else ()
        return cls(name, kind, data_type, " unsigned" in column_type, members, int(width[1]) if kind == "bit" and width else 64)


@dataclass(frozen=True)
class TableSpec:
    """A replicated table: its names on both sides, its key, and its columns."""

    source: str
    target: str
    keys: tuple[str, ...]
    skip: tuple[str, ...] = ()
    columns: tuple[ColumnSpec, ...] = field(default=())

    def __post_init__(self) -> None:
        if not self.keys:
            raise SpecError(f"{self.source}: key_columns is empty")
        if both := sorted(set(self.keys) & set(self.skip)):
            raise SpecError(f"{self.source}: key column {both[0]} is skipped")

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise SpecError(f"{self.source}: no column {name}")

    def with_catalog(self, rows: list[dict]) -> TableSpec:
        """With the columns of a catalogue: dicts of name, data_type, charset, nullable, column_type, ordinal."""
        if not rows:
            raise SpecError(f"no such table: {self.source}")
        rows = sorted(rows, key=lambda r: r["ordinal"])
        for r in rows:
            if r["name"] in self.keys and r["nullable"]:
                raise SpecError(f"{self.source}: key column {r['name']} may be null, and no chunk would hold such rows")
        found = TableSpec(self.source, self.target, self.keys, self.skip, tuple(ColumnSpec.from_catalog(r["name"], r["data_type"], r.get("charset"), r["column_type"]) for r in rows))
        for k in self.keys:
            found.column(k)
        return found

    def with_schema(self, df: DataFrame) -> TableSpec:
        """With the columns of a DataFrame, all plain but bytes and decimals; whether a key is ever null is for :func:`check_keys`."""
        rows = [
            {"name": f.name, "data_type": "varbinary" if f.dataType.typeName() == "binary" else f.dataType.typeName(), "nullable": False, "column_type": "", "ordinal": i}
            for i, f in enumerate(df.schema)
        ]
        return self.with_catalog(rows)

    def kept(self) -> list[ColumnSpec]:
        """The columns that are replicated, in the order of the catalogue."""
        return [c for c in self.columns if c.name not in self.skip]

    def payload(self) -> list[str]:
        """The replicated columns that are not key."""
        return [c.name for c in self.kept() if c.name not in self.keys]


def check_settings(found: dict[str, str]) -> None:
    """The source's settings must be those a complete change log needs."""
    for name, wanted in REQUIRED_SETTINGS.items():
        if str(found.get(name, "")).upper() != wanted:
            raise SpecError(f"{name} is {found.get(name)!r} and must be {wanted!r}")


def check_keys(df: DataFrame, keys: tuple[str, ...]) -> None:
    """No key may be null: looks for one such row."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    if df.where(missing).head(1):
        raise SpecError(f"null in the key {', '.join(keys)}")


def check_unique(df: DataFrame, keys: tuple[str, ...]) -> None:
    """No key may occur twice: looks for one that does."""
    if df.groupBy(*keys).count().where("count > 1").head(1):
        raise SpecError(f"the key {', '.join(keys)} is not unique")


def quote(name: str) -> str:
    """A column name for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def quote_source(name: str) -> str:
    """A name for the source: quoted whole."""
    return quote(name)


def quote_target(name: str) -> str:
    """A name for the target: schema and table are quoted apart."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))
