"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of a ring of 65,536 slots; a row belongs
to the arc that ends at the first point at or after its own slot.  Each shard has
a capacity: ``load`` times its share of the rows, and at a load of 1 the capacities add
up to the number of rows and differ by one at most (the law ``rows``).  Rows that find
their shard full continue clockwise to the next point whose shard has room.  A greater
load lets more rows stay with their arc, so that another shard moves fewer.

Walking the ring row by row would be sequential.  Rows of one arc are
interchangeable except for their order, so the walk runs on the *counts* of the
arcs (``shards * virtual_nodes`` of them, whatever the input size) and yields
segments: "rows 120 to 300 of arc 17 go to shard 5, from slot 40".  A row's rank
within its arc is the count of the ring slots before its own plus its rank in its
own slot.  A slot with over ``HOT`` of the rows (one key may hold a third of them) is cut
by the tasks that wrote its rows, into ``PARTS`` at most, so that no window holds it whole.

Groups: under the law ``rows`` equal texts need not stay together.  Each row has its
place by its key, and rows of equal texts differ in theirs.

Edge cases: a null or repeated key has a hash like any other; ties are broken by
``order``, then by where the row was read.  Null text counts as empty, and a text of any
length is one row.  An empty table gives an empty table.  Columns named ``shard`` or ``slot`` are
replaced, others are kept.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import materialize

RING = 1 << 16
HOT = 1 / 1024
HOT_ROWS = 10_000
PARTS = 64


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """Sorted (ring slot, shard) pairs; of points in one slot the smaller shard stays."""
    points: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual_nodes):
            at = int.from_bytes(hashlib.md5(f"shard {shard} node {v}".encode()).digest()[:2], "big")
            points.setdefault(at, shard)
    return sorted(points.items())


def key_hash(key: Column) -> Column:
    """60 bits of a row's key: the high 16 are its slot of the ring, all of them its order."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long")


def walk(counts: dict[int, int], points: list[tuple[int, int]], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, last rank, shard, slot of the first) from rows per arc.

    First every arc fills its own shard in ring order, then what is left over of
    each arc goes on clockwise to the points after it.
    """
    room, used, segments = list(capacity), [0] * len(capacity), []
    left: list[tuple[int, int, int]] = []  # arc, first rank not placed, rows not placed

    def place(arc: int, at: int, rank: int, rows: int) -> int:
        shard = points[at][1]
        if take := min(rows, room[shard]):
            segments.append((arc, rank, rank + take - 1, shard, used[shard]))
            room[shard] -= take
            used[shard] += take
        return take

    for arc in range(len(points)):
        rows = counts.get(arc, 0)
        took = place(arc, arc, 0, rows)
        if took < rows:
            left.append((arc, took, rows - took))
    for arc, rank, rows in left:
        at = arc
        while rows:
            at = (at + 1) % len(points)
            took = place(arc, at, rank, rows)
            rank, rows = rank + took, rows - took
    return segments


def shard_rows(df: DataFrame, key: str, order: list[Column], shards: int = 8, virtual_nodes: int = 64, load: float = 1.0) -> DataFrame:
    """Add ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard).

    ``order`` breaks ties between rows of equal key.  ``df`` is written once, so it
    should be narrow.  Counts of ring slots come to the driver, and as many rows are
    broadcast: 65,536, and ``PARTS`` for each of the 1,024 hot slots at most, whatever the input size.
    """
    if load < 1:
        raise ValueError("shards of a load below 1 don't hold all rows")
    spark = df.sparkSession
    points = ring_points(shards, virtual_nodes)
    places = [p for p, _ in points]
    tagged = df.drop("shard", "slot").withColumn("__h", key_hash(F.col(key))).withColumn("__row", F.monotonically_increasing_id())
    tagged = materialize(tagged.withColumn("__place", F.shiftright("__h", 44).cast("int")), "ring")
    counted = dict(tuple(r) for r in tagged.groupBy("__place").count().collect())
    total = sum(counted.values())
    hot = [p for p, n in counted.items() if n > max(HOT_ROWS, total * HOT)]
    part = F.pmod(F.shiftright("__row", 33), F.lit(PARTS)).cast("int")
    tagged = tagged.withColumn("__part", F.when(F.col("__place").isin(hot), part).otherwise(0) if hot else F.lit(0))
    cells = [(p, 0, n) for p, n in counted.items() if p not in set(hot)]
    cells += [tuple(r) for r in tagged.where(F.col("__place").isin(hot)).groupBy("__place", "__part").count().collect()] if hot else []
    # in the order of the ring, from the start of arc 0, which lies behind the last point
    per_arc: dict[int, int] = {}
    starts = []  # ring slot, its part, its arc, rank in the arc of its first row, rows
    for place, p, n in sorted(cells, key=lambda c: (c[0] <= places[-1], c[0], c[1])):
        arc = bisect_left(places, place) % len(places)
        starts.append((place, p, arc, per_arc.get(arc, 0), n))
        per_arc[arc] = per_arc.get(arc, 0) + n
    capacity = [total // shards + (s < total % shards) if load == 1 else math.ceil(load * total / shards) for s in range(shards)]
    by_arc: dict[int, list] = {}
    for arc, first, last, shard, slot in sorted(walk(per_arc, points, capacity)):
        by_arc.setdefault(arc, []).append((first, last, shard, slot - first))
    lookup = spark.createDataFrame(
        [(place, p, at, [(last, shard, shift) for first, last, shard, shift in by_arc[arc] if first < at + n and last >= at]) for place, p, arc, at, n in starts],
        T.StructType.fromDDL("__place int, __part int, __from long, __segments array<struct<last:long,shard:int,shift:long>>"),
    )
    ranked = tagged.withColumn("__rank", F.row_number().over(Window.partitionBy("__place", "__part").orderBy("__h", *order, "__row")) - F.lit(1))
    joined = ranked.join(F.broadcast(lookup), ["__place", "__part"]).withColumn("__rank", F.col("__from") + F.col("__rank"))
    return (
        joined.withColumn("__segment", F.filter("__segments", lambda s: s["last"] >= F.col("__rank"))[0])
        .withColumn("shard", F.col("__segment.shard"))
        .withColumn("slot", F.col("__rank") + F.col("__segment.shift"))
        .drop("__h", "__place", "__part", "__row", "__rank", "__from", "__segments", "__segment")
    )


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in eight shards, counts at most one apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(slim, "doc_id", [F.col("text_crc32"), F.col("size")]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
