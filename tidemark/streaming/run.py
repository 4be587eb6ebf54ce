"""A run: sources and targets of a configuration, backfill of its tables in order, then its log.

One position holds for all tables.  Whatever moves it, a window of any table or a
micro-batch, first refuses schema changes, then applies the events of every
configured table up to it, and only then saves it.
"""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import changes, rows
from tidemark.operators.merge import VersionedTable
from tidemark.operators.spec import SpecError, TableSpec, check_keys, check_settings
from tidemark.sources import change_log, database
from tidemark.sources.config import Config, State
from tidemark.streaming.follow import Backfill, Counts, WindowInterrupted, await_mark, follow

log = logging.getLogger("tidemark")


class FileSource:
    """Snapshots as Parquet in ``source/<table>``, each with ``source/<table>.json`` beside it.

    That file gives ``pos``, the position of the log at which the snapshot was taken,
    and may give ``columns``, the table's rows of the source's catalogue.  Without the
    position nothing says which events a row has seen, so the table is refused.
    ``source/settings.json`` may give the source's settings.
    """

    def __init__(self, spark: SparkSession, workspace: str, config: Config) -> None:
        self.spark, self.folder, self.config = spark, os.path.join(workspace, "source"), config
        self.log = os.path.join(workspace, "log")

    def check(self) -> None:
        path = os.path.join(self.folder, "settings.json")
        if os.path.exists(path):
            with open(path) as f:
                check_settings(json.load(f))

    def _about(self, table: str) -> dict:
        try:
            with open(os.path.join(self.folder, f"{table}.json")) as f:
                return json.load(f)
        except FileNotFoundError:
            return {}

    def _rows(self, table: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, table))

    def describe(self, table: TableSpec) -> TableSpec:
        about, df = self._about(table.source), self._rows(table.source)
        if not isinstance(about.get("pos"), int):
            raise SpecError(f"{table.source}: {table.source}.json must say at which position of the log the snapshot was taken")
        spec = table.with_catalog(about["columns"]) if "columns" in about else table.with_schema(df)
        check_keys(df, spec.keys)
        return spec

    def sample(self, spec: TableSpec) -> DataFrame:
        """Rows whose types are those of the snapshot."""
        return self._rows(spec.source)

    def start(self, tables: list[TableSpec]) -> int:
        """Where the log is read from: the earliest of the snapshots."""
        return min(self._about(t.source)["pos"] for t in tables)

    def backfill(self, spec: TableSpec, at: int) -> dict:
        """A snapshot is one chunk: its own position is the low mark, the log's last commit the high one, which must not lie before it."""
        low, high = self._about(spec.source)["pos"], max(at, change_log.last_commit(self.log))
        marks = iter((low, high if high >= low else None))
        return {"read": lambda last, size: self._rows(spec.source), "mark": lambda: next(marks), "whole": True}

    def close(self) -> None:
        """Files hold nothing open."""


class DatabaseSource:
    """A live database, whose log comes back as files in ``log``.  Marks are rows of the watermark table."""

    def __init__(self, spark: SparkSession, workspace: str, config: Config, **waiting) -> None:
        self.spark, self.config, self.log = spark, config, os.path.join(workspace, "log")
        self.options = database.options(config.source)
        self.connection = database.Connection(spark, config.source)
        self.waiting = waiting  # for await_mark

    def check(self) -> None:
        database.read_settings(self.spark, self.config.source.settings_query or database.SETTINGS_QUERY, **self.options)

    def describe(self, table: TableSpec) -> TableSpec:
        return table.with_catalog(database.read_catalog(self.spark, self.config.source.db, table.source, **self.options))

    def _chunk(self, spec: TableSpec, last: list | None, size: int) -> DataFrame:
        return database.read_query(self.spark, database.chunk_query(spec, last, size, self.config.source.url), **self.options)

    def sample(self, spec: TableSpec) -> DataFrame:
        return self._chunk(spec, None, 1)

    def start(self, tables: list[TableSpec]) -> int:
        return change_log.last_commit(self.log)

    def mark(self) -> int | None:
        """Set a mark and wait until the log brings it; earlier marks go, so that the table stays small."""
        name, mark, before = database.quote_target(self.config.watermark_table), changes.new_mark(), change_log.head(self.log)
        if self.config.source.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
            name = database.quote_source(self.config.watermark_table)
        self.connection.execute(f"DELETE FROM {name}")
        self.connection.execute(f"INSERT INTO {name} VALUES ({database.literal(mark)})")

        def find() -> int | None:
            seen = change_log.read_log(self.spark, self.log, after=before)
            found = changes.marks(seen, self.config.source.db, self.config.watermark_table).where(F.col("mark_id") == mark).head(1)
            return found[0].pos if found else None

        return await_mark(find, lambda: change_log.head(self.log), self.config.watermark_timeout_seconds, **self.waiting)

    def backfill(self, spec: TableSpec, at: int) -> dict:
        return {"read": lambda last, size: self._chunk(spec, last, size), "mark": self.mark}

    def close(self) -> None:
        self.connection.close()


@dataclass
class Table:
    spec: TableSpec
    schema: T.StructType
    target: VersionedTable | database.DatabaseTarget


class Replication:
    def __init__(self, spark: SparkSession, workspace: str, config: Config, source=None) -> None:
        self.spark, self.workspace, self.config = spark, workspace, config
        self.state = State.load(os.path.join(workspace, config.state_file))
        self.source = source or (DatabaseSource if config.source.url else FileSource)(spark, workspace, config)
        self.tables: dict[str, Table] = {}

    def open(self) -> None:
        """Check the source, learn the tables, and fix where the log begins."""
        self.source.check()
        for table in self.config.tables:
            spec = self.source.describe(table)
            self.state.progress(spec)
            schema = rows.from_snapshot(self.source.sample(spec), spec).schema
            self.tables[spec.source] = Table(spec, schema, self._target(spec, schema))
        if self.state.log_pos is None:
            self.state.log_pos = self.source.start([t.spec for t in self.tables.values()])
            self.state.save()

    def _target(self, spec: TableSpec, schema: T.StructType):
        if self.config.target.url:
            return database.DatabaseTarget(self.spark, self.config.target, spec)
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        return VersionedTable(self.spark, os.path.join(self.workspace, "target", spec.target), spec.keys, {c: kinds[c] for c in spec.payload()}, {k: kinds[k] for k in spec.keys})

    # --- the log -------------------------------------------------------------------------------

    def events(self, after: int, upto: int) -> DataFrame:
        return self._named(change_log.read_log(self.spark, self.source.log, after, upto))

    def _named(self, events: DataFrame) -> DataFrame:
        return changes.resolve_tables(events) if self.config.table_numbers else events

    def ops(self, events: DataFrame, name: str) -> DataFrame:
        table = self.tables[name]
        return rows.from_log(events, table.spec, self.config.source.db, table.schema)

    def apply(self, events: DataFrame, upto: int) -> None:
        """Events of all tables, and then the position."""
        changes.refuse_ddl(events, self.config.source.db, self.config.skip_ddl_to)
        present = changes.ours(events, self.config.source.db, list(self.tables)).select("tbl").distinct().collect()
        for row in present:
            self.tables[row.tbl].target.apply(self.ops(events, row.tbl), upto)
        self.state.log_pos = max(upto, self.state.log_pos)
        self.state.save()

    def advance(self, upto: int) -> None:
        """Bring all targets up to a position of the log."""
        if upto > self.state.log_pos:
            held = self.events(self.state.log_pos, upto).persist()
            try:
                self.apply(held, upto)
            finally:
                held.unpersist()

    # --- phases --------------------------------------------------------------------------------

    def backfill(self, stop: Callable[[], bool]) -> dict[str, Counts]:
        """The tables in their order.  One whose window does not close is left for another run."""
        counts = {}
        for name, table in self.tables.items():
            if stop():
                break
            ways = self.source.backfill(table.spec, self.state.log_pos)
            ops = lambda low, high, name=name: self.ops(self.events(low, high), name)
            convert = lambda df, spec=table.spec: rows.from_snapshot(df, spec)
            work = Backfill(table.spec, ops=ops, advance=self.advance, target=table.target, state=self.state, size=self.config.chunk_size, convert=convert, **ways)
            try:
                counts[name] = work.run(stop)
            except WindowInterrupted as e:
                log.warning("%s; its chunk is read again in the next run", e)
                self.state.save()
        return counts

    def done(self) -> bool:
        return self.state.all_done([t.spec for t in self.tables.values()])

    def follow(self, stop: Callable[[], bool], once: bool) -> None:
        """One stream for all tables, until asked to stop."""
        stream = change_log.stream_log(self.spark, self.source.log, self.state.log_pos)
        query = follow(stream, lambda batch, pos: self.apply(self._named(batch), pos), os.path.join(self.workspace, "checkpoints", "log"), available_now=once)
        try:
            while query.isActive and (once or not stop()):
                query.awaitTermination(1)
            if query.exception() is not None:
                raise query.exception()
        finally:
            query.stop()

    def close(self) -> None:
        """Let go of everything, whatever fails; the saved position is that of the last commit applied."""
        for thing in (self.source, *(t.target for t in self.tables.values())):
            try:
                getattr(thing, "close", lambda: None)()
            except Exception as e:  # noqa: BLE001
                log.warning("closing %s: %s", type(thing).__name__, e)


def replicate(spark: SparkSession, workspace: str, config: Config, stop: Callable[[], bool] = lambda: False, once: bool = False, source=None) -> dict[str, Counts]:
    """Backfill every table, then follow the log; ``once`` ends when the log is read."""
    run = Replication(spark, workspace, config, source)
    try:
        run.open()
        counts = run.backfill(stop)
        if run.done() and not stop():
            log.info("all tables are copied; the log is followed from position %d", run.state.log_pos)
            run.follow(stop, once)
        return counts
    finally:
        run.close()
