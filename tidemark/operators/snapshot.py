"""Reading a table in key order, chunk by chunk or all chunks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import after
from tidemark.shared import materialize


def next_chunk(df: DataFrame, keys: tuple[str, ...], last: list | None, size: int) -> DataFrame:
    """The first ``size`` rows in key order, behind the key ``last`` if there is one."""
    behind = df if last is None else df.where(after(keys, last))
    return behind.orderBy(*keys).limit(size)


def cursor(chunk: DataFrame, keys: tuple[str, ...]) -> list | None:
    """The greatest key of a chunk, or None if the chunk is empty."""
    row = chunk.agg(F.max(F.struct(*keys))).head()[0]
    return None if row is None else list(row)


def assign_chunks(df: DataFrame, keys: tuple[str, ...], size: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Keys (and the columns ``carry``) with ``chunk_id``, counted from 0 in key order.

    Keys are dealt by ranges and sorted, so a row's number is the count of the
    partitions before its own plus its place there; no task sees all rows.  The
    dealt keys are written once, as ranges are sampled anew in each run; the
    driver gets a count per partition.
    """
    spark = df.sparkSession
    dealt = df.select(*keys, *carry).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()), "chunks")
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).count().collect()}
    offsets, total = [], 0
    for p in sorted(counts):
        offsets.append((p, total))
        total += counts[p]
    if not offsets:
        return placed.drop("__id").withColumn("chunk_id", F.lit(None).cast("long"))
    starts = spark.createDataFrame(offsets, "__p long, __from long")
    numbered = placed.withColumn("__p", part).join(F.broadcast(starts), "__p")
    chunk = F.floor((F.col("__from") + place) / size).cast("long")
    return numbered.select(*keys, *carry, chunk.alias("chunk_id"))


def chunk_cursors(assigned: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows and greatest key of each chunk."""
    return assigned.groupBy("chunk_id").agg(F.max(F.struct(*keys)).alias("last_key"), F.count("*").alias("n_rows"))
