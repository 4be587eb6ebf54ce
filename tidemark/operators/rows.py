"""Rows of a table, from its snapshot or from its log, in the one form that the target takes.

A row of the log is a JSON object of all columns of the table.  Its cells are as a
binary row log has them: whole numbers with the sign bit of their width, the number of
an enumeration's label, the mask of a set's members, base64 of bits and bytes, the digits of a
decimal, microseconds of a time of day or duration, and text of all else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cells import for_target
from tidemark.operators import changes
from tidemark.operators.spec import SpecError, TableSpec

STAMP = {"op", "pos", "seq"}
_BY_KIND = {"set": T.LongType(), "enum": T.LongType(), "bit": T.BinaryType(), "binary": T.BinaryType(), "json": T.StringType(), "decimal": T.StringType()}
_BY_TYPE = {
    **dict.fromkeys(("tinyint", "smallint", "mediumint", "int", "bigint", "time", "year"), T.LongType()),
    **dict.fromkeys(("char", "varchar", "tinytext", "text", "mediumtext", "longtext"), T.StringType()),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
}


def from_snapshot(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The replicated columns of a snapshot, converted."""
    kinds = {f.name: f.dataType for f in df.schema}
    if taken := sorted(STAMP & {c.name for c in spec.kept()}):
        raise SpecError(f"{spec.source}: {taken[0]} is a name of the stamp that rows get, so a column can't have it")
    if missing := [c.name for c in spec.kept() if c.name not in kinds]:
        raise SpecError(f"{spec.source}: the snapshot has no column {missing[0]}")
    return df.select(*[for_target(F.col(f"`{c.name}`"), kinds[c.name], c, False).alias(c.name) for c in spec.kept()])


def _log_types(spec: TableSpec, target: T.StructType) -> dict[str, T.DataType]:
    """The type of each replicated column in a row of the log; what the catalogue doesn't say is as in the target."""
    return {c.name: _BY_KIND.get(c.kind) or _BY_TYPE.get(c.source_type) or target[c.name].dataType for c in spec.kept()}


def _parsed(text: Column, spec: TableSpec, kinds: dict[str, T.DataType]) -> Column:
    """A JSON row as a struct; another number of cells than columns is an error, and so is what is no JSON."""
    n = F.size(F.json_object_keys(text))
    whole = F.when(n == len(spec.columns), text).otherwise(F.raise_error(F.concat(F.lit(f"{spec.source}: {len(spec.columns)} columns, cells: "), n.cast("string"))))
    row = T.StructType([T.StructField(c, k) for c, k in kinds.items()])
    return F.when(text.isNotNull(), F.from_json(whole, row, {"mode": "FAILFAST"}))


def from_log(events: DataFrame, spec: TableSpec, db: str, target: T.StructType) -> DataFrame:
    """Operations by key (the target's columns, op, pos, seq) of the table's events."""
    kinds = _log_types(spec, target)
    sides = ("before", "after")
    rows = changes.row_changes(changes.ours(events, db, [spec.source])).select("pos", "n", *[_parsed(F.col(s), spec, kinds).alias(s) for s in sides])

    def converted(side: str) -> Column:
        cells = [for_target(F.col(side)[c.name], kinds[c.name], c, True).cast(target[c.name].dataType).alias(c.name) for c in spec.kept()]
        return F.when(F.col(side).isNotNull(), F.struct(*cells)).alias(side)

    found = changes.operations(rows.select("pos", "n", *[converted(s) for s in sides]), keys=spec.keys)
    cells = [F.col("row")[c].alias(c) for c in target.fieldNames()]
    return found.select(*cells, "op", "pos", (F.col("n") * 2 + F.col("seq")).cast("int").alias("seq"))
