"""The change log: from events to ordered operations by key.

An event is a row (pos, kind, db, tbl, table_id, changes, statement, mark_id).  ``kind``
is insert, update, delete, commit, mark, ddl, heartbeat, rotate or map;
``changes`` is array<struct<before, after>> of full rows, null where there is none.
A row event names its table, or gives a number that an earlier map event has named.
The order of the log is (pos, seq), never the order of rows in a DataFrame.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_KINDS = ("insert", "update", "delete")
#: First words of statements that change a schema.
DDL_WORDS = ("CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME")


class SchemaChange(RuntimeError):
    """The log holds a statement that cannot be replayed."""


def ours(log: DataFrame, db: str, tables: list[str]) -> DataFrame:
    """Row events of the replicated tables; marks, control events and other tables drop out."""
    return log.where(F.col("kind").isin(*ROW_KINDS) & (F.col("db") == db) & F.col("tbl").isin(*tables))


def table_names(log: DataFrame) -> DataFrame:
    """From which position on (``since``, up to before ``until``) a table number stands for which db and tbl: a row each time that changes."""
    number = Window.partitionBy("table_id").orderBy("since")
    maps = log.where((F.col("kind") == "map") & F.col("table_id").isNotNull()).select("table_id", F.col("pos").alias("since"), F.struct("db", "tbl").alias("name"))
    new = maps.withColumn("before", F.lag("name").over(number)).where("before is null or before <> name")
    return new.select("table_id", "since", F.lead("since").over(number).alias("until"), "name")


def resolve_tables(log: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Row events that give a number only get the db and tbl it stood for (by ``names``, or the map events of the log itself); without one, the event is an error when it is read."""
    names = table_names(log) if names is None else names
    others = [c for c in log.columns if c not in ("db", "tbl")]
    e, m = log.alias("e"), names.alias("m")
    numbered = F.col("e.kind").isin(*ROW_KINDS) & F.col("e.tbl").isNull() & F.col("e.table_id").isNotNull()
    found = e.join(m, numbered & (F.col("e.table_id") == F.col("m.table_id")) & (F.col("e.pos") >= F.col("m.since")) & (F.col("m.until").isNull() | (F.col("e.pos") < F.col("m.until"))), "left")
    unknown = F.raise_error(F.concat(F.lit("no table has the number "), F.col("e.table_id").cast("string"), F.lit(" at position "), F.col("e.pos").cast("string")))
    name = F.when(~numbered, F.struct("e.db", "e.tbl")).otherwise(F.coalesce("m.name", unknown))
    return found.select(*[F.col(f"e.{c}") for c in others], name.alias("__n")).select(*others, "__n.db", "__n.tbl")


def row_changes(log: DataFrame) -> DataFrame:
    """A row for each change of a row event, numbered by ``n`` within it; an empty event gives none."""
    others = [c for c in log.columns if c != "changes"]
    found = log.where(F.col("kind").isin(*ROW_KINDS)).select(*others, F.posexplode("changes").alias("n", "change"))
    return found.select(*others, "n", F.col("change.before").alias("before"), F.col("change.after").alias("after"))


def operations(changes: DataFrame, before: str = "before", after: str = "after", keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """Deletes ('d') and upserts ('u'), with ``seq`` 1 and 2 so that a moved key is left before it is taken.

    An update that keeps its key is one upsert; columns ``op``, ``row`` and ``seq`` are added.
    """
    def identity(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{k}") for k in keys])

    gone = F.col(after).isNull() | (F.col(before).isNotNull() & ~identity(before).eqNullSafe(identity(after)))
    delete = F.when(F.col(before).isNotNull() & gone, F.struct(F.lit("d").alias("op"), F.lit(1).alias("seq"), F.col(before).alias("row")))
    upsert = F.when(F.col(after).isNotNull(), F.struct(F.lit("u").alias("op"), F.lit(2).alias("seq"), F.col(after).alias("row")))
    others = [c for c in changes.columns if c not in (before, after)]
    return changes.select(*others, F.explode(F.array_compact(F.array(delete, upsert))).alias("__o")).select(*others, "__o.*")


def cells_to_row(cells: Column, names: list[str]) -> Column:
    """A positional list of cells as a struct; another number of cells than columns is an error."""
    checked = F.when(F.size(cells) == len(names), cells).otherwise(F.raise_error(F.concat(F.lit(f"{len(names)} columns, cells: "), F.size(cells).cast("string"))))
    return F.struct(*[checked[i].alias(n) for i, n in enumerate(names)])


def commit_cut(log: DataFrame, upto: int | None = None) -> int | None:
    """The last commit's position: what lies behind it belongs to an open transaction."""
    seen = log if upto is None else log.where(F.col("pos") <= upto)
    return seen.where(F.col("is_commit")).agg(F.max("pos")).head()[0]


def marks(log: DataFrame, db: str, table: str) -> DataFrame:
    """(mark_id, pos) of watermark rows: inserts into the watermark table."""
    return log.where((F.col("kind") == "mark") & (F.col("db") == db) & (F.col("tbl") == table)).select("mark_id", "pos")


def new_mark() -> str:
    """An id for a watermark row: 32 hexadecimal digits."""
    return uuid.uuid4().hex


def is_ddl(statement: Column, default_db: Column, db: str) -> Column:
    """Whether a statement changes a schema of ours: by its first word, then by its database or by ``db.`` in its text."""
    word = F.upper(F.regexp_extract(statement, r"(?U)^\s*(\S+)", 1))
    lower = F.lower(statement)
    named = lower.contains(f"`{db.lower()}`.") | lower.contains(f"{db.lower()}.")
    return word.isin(*DDL_WORDS) & (F.coalesce(default_db == db, F.lit(False)) | named)


def is_ddl_strict(statement: Column, default_db: Column, db: str) -> Column:
    """The same past leading comments, and with the database's name as a whole word only."""
    bare = F.regexp_replace(statement, r"^(\s|/\*.*?\*/|--[^\n]*\n|#[^\n]*\n)+", "")
    word = F.upper(F.regexp_extract(bare, r"^(\w+)", 1))
    named = F.lower(bare).rlike(rf"(^|[^\w$`])`?{re.escape(db.lower())}`?\s*\.")
    return word.isin(*DDL_WORDS) & (F.coalesce(default_db == db, F.lit(False)) | named)


def refuse_ddl(log: DataFrame, db: str, skip_to: int | None = None, strict: bool = False) -> None:
    """Raise on the first schema change behind ``skip_to``; looks at one row."""
    test = (is_ddl_strict if strict else is_ddl)(F.col("statement"), F.col("db"), db)
    found = log.where((F.col("kind") == "ddl") & test)
    if skip_to is not None:
        found = found.where(F.col("pos") > skip_to)
    if first := found.orderBy("pos").head(1):
        raise SchemaChange(f"the log changes the schema at position {first[0].pos}, which no target follows: {first[0].statement[:200]}")
