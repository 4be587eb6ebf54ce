"""Setting a snapshot against the changes made while it was read.

A chunk is read between two marks in the log, ``low`` and ``high``.  Rows whose key
changed between them are superseded by the log; all others are fresh.  The same
final state comes from one fold: give every snapshot row the position of its low
mark and keep, for each key, what has the greatest position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = (1 << 31) - 1


def inside(low: int, high: int, pos: str = "pos") -> Column:
    """Whether the window between the marks is open."""
    return (F.col(pos) > low) & (F.col(pos) <= high)


def changed_keys(ops: DataFrame, keys: tuple[str, ...], low: int, high: int) -> DataFrame:
    """Distinct keys, before and after, of the operations inside the window."""
    return ops.where(inside(low, high)).select(*keys).distinct()


def fresh(snapshot: DataFrame, changed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Snapshot rows whose key did not change; the plan follows the sizes of both sides."""
    return snapshot.join(changed, list(keys), "left_anti")


def superseded(snapshot: DataFrame, changed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return snapshot.join(changed, list(keys), "left_semi")


def counts(snapshot: DataFrame, changed: DataFrame, keys: tuple[str, ...], by: str) -> DataFrame:
    """Fresh, superseded and all rows by the column ``by``."""
    marked = snapshot.join(changed.withColumn("__hit", F.lit(True)), list(keys), "left")
    return marked.groupBy(by).agg(F.count_if(F.col("__hit").isNull()).alias("fresh"), F.count_if("__hit").alias("superseded"), F.count("*").alias("total"))


def dedup_last(df: DataFrame, keys: tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row for each key, the last in ``order`` (which should be total)."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__row")).select(*keys, *[F.col("__row")[c].alias(c) for c in others])


def latest(ops: DataFrame, keys: tuple[str, ...], payload: list[str]) -> DataFrame:
    """The last operation of each key: op, payload, and its pos and seq.  Partial results are combined before the shuffle."""
    stamp = F.struct("pos", "seq")
    last = F.max_by(F.struct("op", *payload, "pos", "seq"), stamp).alias("__last")
    return ops.groupBy(*keys).agg(last).select(*keys, "__last.*")


def latest_state(ops: DataFrame, keys: tuple[str, ...], payload: list[str]) -> DataFrame:
    """What remains after all operations in log order."""
    return latest(ops, keys, payload).where("op <> 'd'").select(*keys, *payload)


def stamp(snapshot: DataFrame, low: int | Column) -> DataFrame:
    """Snapshot rows as upserts at their low mark, behind all events of that position."""
    at = F.lit(low).cast("long") if isinstance(low, int) else low
    return snapshot.withColumns({"op": F.lit("u"), "pos": at, "seq": F.lit(LAST)})


def stamped_fold(snapshot: DataFrame, ops: DataFrame, keys: tuple[str, ...], payload: list[str], low: int | Column, high: int) -> DataFrame:
    """The state at ``high`` from snapshot and log in one shuffle."""
    columns = [*keys, *payload, "op", "pos", "seq"]
    both = stamp(snapshot, low).select(*columns).unionByName(ops.where(F.col("pos") <= high).select(*columns))
    return latest_state(both, keys, payload)


def backfill_chunk(snapshot: DataFrame, ops: DataFrame, keys: tuple[str, ...], payload: list[str], low: int, high: int) -> DataFrame:
    """The state at ``high`` the explicit way: all events are applied, then the fresh rows."""
    columns = [*keys, *payload]
    kept = fresh(snapshot, changed_keys(ops, keys, low, high), keys).select(*columns)
    applied = latest(ops.where(F.col("pos") <= high), keys, payload)
    untouched = applied.where("op <> 'd'").select(*columns).join(kept, list(keys), "left_anti")
    return untouched.unionByName(kept)
