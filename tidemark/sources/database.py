"""Databases through JDBC: reads and bulk writes are Spark's, single statements go over one connection of the driver.

The driver class must be on Spark's class path.  An embedded database lives in the driver's JVM, which
executors of a cluster can't reach; its rows go there and back as files in the shared folder.
"""

from __future__ import annotations

import os
import uuid
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reconcile import latest
from tidemark.operators.spec import REQUIRED_SETTINGS, SpecError, TableSpec, check_settings, quote_source, quote_target
from tidemark.shared import is_local, new_path
from tidemark.sources.config import Database

#: Rows to a statement when writing to a database.
PAGE = 100
SETTINGS_QUERY = "SELECT " + ", ".join(f"@@GLOBAL.{s} AS {s}" for s in REQUIRED_SETTINGS)
CATALOG_QUERY = "SELECT COLUMN_NAME, DATA_TYPE, CHARACTER_SET_NAME, IS_NULLABLE, COLUMN_TYPE, ORDINAL_POSITION FROM information_schema.COLUMNS WHERE TABLE_SCHEMA = {db} AND TABLE_NAME = {table}"


def options(database: Database) -> dict[str, str]:
    """What Spark's JDBC source needs to connect."""
    found = {"url": database.url, "user": database.user, "password": database.password()}
    return found | ({"driver": database.driver} if database.driver else {})


def read_table(spark: SparkSession, url: str, table: str, skip: tuple[str, ...] = (), **more: str) -> DataFrame:
    """A table as a DataFrame; keyset predicates on it run in the database.  Skipped columns are not read."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **more).load()
    if _out_of_reach(spark, url):
        df = _exported(spark, f"SELECT * FROM {table}", df.schema, url=url, **more)
    return df.drop(*skip)


def read_query(spark: SparkSession, query: str, **more: str) -> DataFrame:
    df = spark.read.format("jdbc").options(query=query, **more).load()
    return _exported(spark, query, df.schema, **more) if _out_of_reach(spark, more["url"]) else df


def write_table(df: DataFrame, table: str, **about: str) -> None:
    """Append rows that have all columns of the table, in pages, by Spark's tasks."""
    if _out_of_reach(df.sparkSession, about["url"]):
        _import(df, table, **about)
    else:
        df.write.format("jdbc").options(dbtable=quote_target(table), batchsize=str(PAGE), **about).mode("append").save()


def _out_of_reach(spark: SparkSession, url: str) -> bool:
    """Whether tasks can't connect: the database is embedded in the driver's JVM, and they run in others."""
    return url.startswith("jdbc:derby:") and not url.startswith("jdbc:derby://") and not is_local(spark)


def _file_for(spark: SparkSession, name: str) -> str:
    path = new_path(spark, name).removeprefix("file://")
    if "://" in path:
        raise SpecError(f"an embedded database writes and reads files of a local folder, not {path}")
    return path


def _exported(spark: SparkSession, query: str, schema: T.StructType, **about: str) -> DataFrame:
    """Rows of a query by a file that the embedded database writes."""
    path = _file_for(spark, "exported")
    _call(spark, about, "SYSCS_EXPORT_QUERY(?, ?, NULL, NULL, 'UTF-8')", query, path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    null = uuid.uuid4().hex  # read for a cell without quotes and text, as an empty text has quotes
    rows = spark.read.schema(text).csv(path, quote='"', escape='"', nullValue=null, emptyValue="", multiLine=True, mode="FAILFAST", maxCharsPerColumn=-1)
    cells = [F.unhex(rows[f.name]) if isinstance(f.dataType, T.BinaryType) else rows[f.name].cast(f.dataType) for f in schema]
    return rows.select(*[c.alias(f.name) for c, f in zip(cells, schema, strict=True)])


def _import(df: DataFrame, table: str, **about: str) -> None:
    """Append rows by files that the embedded database reads; all cells but nulls are quoted."""
    spark, path = df.sparkSession, _file_for(df.sparkSession, "imported")
    schema, _, name = table.rpartition(".")

    def cell(column: str):
        c = F.hex(df[column]) if isinstance(df.schema[column].dataType, T.BinaryType) else df[column].cast("string")
        return F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))

    columns = spark.read.format("jdbc").options(dbtable=quote_target(table), **about).load().columns
    df.select(F.concat_ws(",", *map(cell, columns))).write.text(path)
    for file in sorted(os.listdir(path)):
        if file.startswith("part-") and os.path.getsize(f"{path}/{file}"):
            _call(spark, about, "SYSCS_IMPORT_DATA(?, ?, NULL, NULL, ?, NULL, NULL, 'UTF-8', 0)", schema or None, name, f"{path}/{file}")


def _call(spark: SparkSession, about: dict[str, str], procedure: str, *arguments: str | None) -> None:
    held = _connect(spark, **about)
    try:
        call = held.prepareCall(f"CALL SYSCS_UTIL.{procedure}")
        for i, x in enumerate(arguments, 1):
            call.setString(i, x)
        call.execute()
        call.close()
    finally:
        held.close()


def single_row(df: DataFrame) -> dict | None:
    """The first row, its names in lower case."""
    rows = df.head(1)
    return {k.lower(): v for k, v in rows[0].asDict().items()} if rows else None


def read_settings(spark: SparkSession, query: str = SETTINGS_QUERY, **more: str) -> None:
    """Check the settings that ``query`` returns as one row."""
    check_settings(single_row(read_query(spark, query, **more)) or {})


def read_catalog(spark: SparkSession, db: str, table: str, **more: str) -> list[dict]:
    """The columns of a table, as ``TableSpec.with_catalog`` takes them."""
    rows = read_query(spark, CATALOG_QUERY.format(db=literal(db), table=literal(table)), **more).collect()
    names = ("name", "data_type", "charset", "nullable", "column_type", "ordinal")
    return [dict(zip(names, r, strict=True)) | {"nullable": str(r[3]).upper() != "NO"} for r in rows]


def literal(value, backslash: bool = False) -> str:
    """A value in SQL; ``backslash`` if the database takes that for an escape."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return repr(value) if isinstance(value, float) else str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if not isinstance(value, str):
        raise SpecError(f"a key of type {type(value).__name__} has no literal")
    text = value.replace("\\", "\\\\") if backslash else value
    return "'" + text.replace("'", "''") + "'"


def chunk_query(spec: TableSpec, last: list | None, size: int, url: str) -> str:
    """The next rows in key order as a statement for the database, whose index on the key serves it."""
    mysql = url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))
    name = quote_source if mysql else quote_target
    behind = ""
    if last is not None:
        tests = []
        for k in range(len(spec.keys)):
            equal = [f"{name(c)} = {literal(v, mysql)}" for c, v in zip(spec.keys[:k], last, strict=False)]
            tests.append("(" + " AND ".join([*equal, f"{name(spec.keys[k])} > {literal(last[k], mysql)}"]) + ")")
        behind = " WHERE " + " OR ".join(tests)
    rows = f"LIMIT {size}" if mysql else f"FETCH FIRST {size} ROWS ONLY"
    return f"SELECT {', '.join(name(c.name) for c in spec.kept())} FROM {name(spec.source)}{behind} ORDER BY {', '.join(name(k) for k in spec.keys)} {rows}"


def _connect(spark: SparkSession, url: str, user: str, password: str, driver: str | None = None):
    """A JDBC connection in the driver's JVM."""
    jvm = spark.sparkContext._jvm
    about = jvm.java.util.Properties()
    for k, v in (("user", user), ("password", password)):
        about.setProperty(k, v)
    if driver:
        return jvm.java.lang.Class.forName(driver).getDeclaredConstructor(None).newInstance(None).connect(url, about)
    return jvm.java.sql.DriverManager.getConnection(url, about)


class Connection:
    """One JDBC connection of the driver."""

    def __init__(self, spark: SparkSession, database: Database) -> None:
        self._held = _connect(spark, **options(database))

    def execute(self, *statements: str) -> None:
        """All statements in one transaction."""
        self._held.setAutoCommit(False)
        try:
            for sql in statements:
                statement = self._held.createStatement()
                statement.execute(sql)
                statement.close()
            self._held.commit()
        except BaseException:
            self._held.rollback()
            raise

    def exists(self, table: str) -> bool:
        schema, _, name = table.rpartition(".")
        found = self._held.getMetaData().getTables(None, schema or None, name, None)
        try:
            return found.next()
        finally:
            found.close()

    def decimals(self, table: str) -> dict[str, str]:
        """The types of the table's decimal columns."""
        schema, _, name = table.rpartition(".")
        found, out = self._held.getMetaData().getColumns(None, schema or None, name, None), {}
        while found.next():
            if found.getString("TYPE_NAME").upper() in ("DECIMAL", "NUMERIC"):
                out[found.getString("COLUMN_NAME")] = f"decimal({min(found.getInt('COLUMN_SIZE'), 38)},{found.getInt('DECIMAL_DIGITS')})"
        found.close()
        return out

    def close(self) -> None:
        self._held.close()


def merge_sql(spec: TableSpec, staging: str, postgres: bool = False) -> list[str]:
    """Statements that fold a staging table (the replicated columns and op) into the target; columns in the order of their names."""
    names = sorted(c.name for c in spec.kept())
    kinds = {c.name: c.kind for c in spec.columns}
    into, source = quote_target(spec.target), quote_target(staging)
    listed = ", ".join(map(quote_target, names))
    match = " AND ".join(f"s.{quote_target(k)} = {into}.{quote_target(k)}" for k in spec.keys)
    cells = ", ".join(f"s.{quote_target(n)}" + ("::jsonb" if postgres and kinds[n] == "json" else "") for n in names)
    insert = f"INSERT INTO {into} ({listed}) SELECT {cells} FROM {source} s WHERE s.op = 'u'"
    if not postgres:
        return [f"DELETE FROM {into} WHERE EXISTS (SELECT 1 FROM {source} s WHERE {match})", insert]
    others = ", ".join(f"{quote_target(n)} = EXCLUDED.{quote_target(n)}" for n in names if n not in spec.keys)
    found = f" ON CONFLICT ({', '.join(map(quote_target, spec.keys))}) DO " + (f"UPDATE SET {others}" if others else "NOTHING")
    return [f"DELETE FROM {into} WHERE EXISTS (SELECT 1 FROM {source} s WHERE {match} AND s.op = 'd')", insert + found]


class DatabaseTarget:
    """A table of a database.  A batch goes to a staging table in pages, by Spark's tasks, and from there in one transaction."""

    def __init__(self, spark: SparkSession, database: Database, spec: TableSpec) -> None:
        self.spark, self.database, self.spec = spark, database, spec
        self.staging = f"{spec.target}__incoming"
        self.postgres = database.url.startswith("jdbc:postgresql:")
        self.connection = Connection(spark, database)
        if not self.connection.exists(spec.target):
            raise SpecError(f"the target has no table {spec.target}")
        self.decimals = self.connection.decimals(spec.target)

    def _renew(self) -> None:
        cells = ", ".join(f"{quote_target(c.name)}::text AS {quote_target(c.name)}" if self.postgres and c.kind == "json" else quote_target(c.name) for c in self.spec.kept())
        staging = quote_target(self.staging)
        drop = [f"DROP TABLE {staging}"] if self.connection.exists(self.staging) else []
        self.connection.execute(*drop, f"CREATE TABLE {staging} AS SELECT {cells} FROM {quote_target(self.spec.target)} WITH NO DATA", f"ALTER TABLE {staging} ADD COLUMN op CHAR(1)")

    def apply(self, ops: DataFrame, pos: int | None = None) -> None:
        """Fold operations to one per key and merge them; repeating it changes nothing."""
        keys, payload = self.spec.keys, self.spec.payload()
        folded = latest(ops, keys, payload).select(*keys, *payload, "op")
        for name, kind in self.decimals.items():
            if name in folded.columns:
                folded = folded.withColumn(name, folded[name].cast(kind))
        folded = folded.select(*sorted(folded.columns))
        self._renew()
        op = "op" if self.postgres else "OP"  # what an unquoted name is at home
        write_table(folded.withColumnRenamed("op", op), self.staging, **options(self.database))
        self.connection.execute(*self._index(), *merge_sql(self.spec, self.staging, self.postgres), f"DROP TABLE {quote_target(self.staging)}")

    def _index(self) -> list[str]:
        """Where the planner has no hash join for what the merge asks, each row of the target looks its key up."""
        if self.postgres:
            return []
        return [f"CREATE INDEX {quote_target(f'{self.staging}__keys')} ON {quote_target(self.staging)} ({', '.join(map(quote_target, self.spec.keys))})"]

    def read(self) -> DataFrame:
        return read_table(self.spark, table=quote_target(self.spec.target), **options(self.database))

    def purge(self) -> None:
        """Nothing to drop: deleted rows leave nothing behind."""

    def close(self) -> None:
        self.connection.close()
