"""Inputs of the query catalogue, derived from the star-schema tables; each has the same form in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.change_log import _open

DB, TABLE = "shop", "users"
PAYLOAD = ["value", "props"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_events(events: DataFrame) -> DataFrame:
    """A change log: one operation per event, ten events to a transaction."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events.select(
        F.col("event_id").alias("pos"),
        F.lit(2).alias("seq"),
        F.floor(F.col("event_id") / 10).alias("txn"),
        (F.col("event_id") % 10 == 9).alias("is_commit"),
        F.lit(DB).alias("db"),
        F.lit(TABLE).alias("tbl"),
        F.col("user_id").alias("k"),
        op.alias("op"),
        F.when(op != "d", F.col("value")).alias("value"),
        F.when(op != "d", F.col("props")).alias("props"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def events_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as events with lists of before and after rows; every 17th change that is no delete moves its key by 1000."""
    found = log(spark, sf_dir)
    moves = (F.col("pos") % 17 == 0) & (F.col("op") != "d")
    kind = F.when(moves, "update").when(F.col("op") == "c", "insert").when(F.col("op") == "d", "delete").otherwise("update")
    row = lambda k: F.struct(k.alias("k"), F.col("value"), F.col("props"))
    before = F.when(moves | (F.col("op") != "c"), row(F.col("k")))
    after = F.when(F.col("op") != "d", row(F.when(moves, F.col("k") + 1000).otherwise(F.col("k"))))
    return found.select("pos", "txn", "is_commit", "db", "tbl", kind.alias("kind"), F.array(F.struct(before.alias("before"), after.alias("after"))).alias("changes"))


def write_log(events: DataFrame, folder: str) -> None:
    """Events as a change log: ranges of positions, a file each, by the tasks that hold them."""
    cells = F.struct("pos", *[c for c in events.columns if c != "pos"])
    lines = events.select("pos", F.to_json(cells, {"ignoreNullFields": "false"}).alias("line")).repartitionByRange("pos").sortWithinPartitions("pos")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            if batch.num_rows:
                with files.open_output_stream(f"{base}/{batch.column(0)[0].as_py():012d}.jsonl") as f:
                    f.write("\n".join(batch.column(1).to_pylist()).encode())
                yield batch.select([0])[:1]

    lines.mapInArrow(write, "pos long").collect()  # a row for each file


def window(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    """Low mark, time of the snapshot and high mark, in proportion to the length of the log."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).head()[0]
    return tuple(last * n // 1000 for n in (538, 540, 544))


LOG_SQL = """log as (
  select event_id as pos, 2 as seq, event_id // 10 as txn, event_id % 10 = 9 as is_commit, 'shop' as db, 'users' as tbl, user_id as k,
    case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
    case when event_type <> 'error' then value end as value, case when event_type <> 'error' then props end as props
  from events)"""
MOVED_SQL = f"""{LOG_SQL}, moved as (
  select pos, txn, is_commit, 2 as seq, case when pos % 17 = 0 and op <> 'd' then k + 1000 else k end as k, case when op = 'd' then 'd' else 'u' end as op, value, props from log
  union all
  select pos, txn, is_commit, 1 as seq, k, 'd', null, null from log where pos % 17 = 0 and op <> 'd')"""
WINDOW_SQL = "w as (select max(event_id) * 538 // 1000 as lw, max(event_id) * 540 // 1000 as t, max(event_id) * 544 // 1000 as hw from events)"
