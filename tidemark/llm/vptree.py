"""Nearest neighbours by inner product: a vantage-point tree per shard.

The largest inner product becomes the smallest distance once every vector gets
one more coordinate, sqrt(M^2 - |x|^2), that lifts it to a sphere of radius M
(the largest norm); queries get 0 there.  Distances to a vantage point then follow
from inner products alone.

A shard (about ``SHARD`` rows, by a hash of the row) is a tree: a node splits its rows
at the median distance to its vantage point and keeps the least and greatest
distance of either half.  Every query first walks to the leaf it falls in; the
20th best inner product found there bounds its radius.  Then all queries of a block
walk the tree together, and a query enters a half only if the triangle inequality
does not exclude it, with its radius multiplied by ``factor``: 1 is exact, less
prunes more and may miss neighbours.

Inner products in the walk come from matrix products; the candidates within a
rounding error of the 20th are computed again term by term, so that equal vectors
have equal scores and ties go to the smaller vec_id.

Queries meet shards in blocks of ``BLOCK``; a task has one tree and ``GROUP`` blocks, one
after the other, so a tree is sent once for so many queries.

Edge cases: vectors that are null, empty, zero, or hold a null or non-finite component
take no part, nor do rows without vec_id.  A query is a row, and every other row is a
candidate, one of the same vec_id as well; so a repeated vec_id is asked for each of
its rows, and equal results come once for each.  Vectors meet those of their own length
only.  Extra columns are not read; an empty table gives an empty table; with fewer
candidates all are returned.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import bound_batches, materialize

SHARD = 16_384
BLOCK = 256
LEAF = 256
GROUP = 16
OUT = "query_id long, rank int, vec_id long, score double"


def build(ids: np.ndarray, vectors: np.ndarray, top: float, rows: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """A tree over these vectors; ``top`` is the largest squared norm of all shards, ``rows`` tells rows of equal vec_id apart."""
    n = len(ids)
    own = ids if rows is None else rows
    order = np.lexsort((own, ids))
    nodes: list[list[float]] = []  # begin, end, vantage row, left, right, then least and greatest distance of either half
    extra = np.sqrt(np.maximum(top - (vectors * vectors).sum(1), 0))
    stack = [(0, n, -1, 0)]
    while stack:
        begin, end, parent, side = stack.pop()
        me = len(nodes)
        nodes.append([begin, end, -1, -1, -1, 0, 0, 0, 0])
        if parent >= 0:
            nodes[parent][3 + side] = me
        if end - begin <= LEAF:
            continue
        held = order[begin:end]
        centre, level = vectors[held].mean(0), extra[held].mean()
        v = held[int(np.argmax(((vectors[held] - centre) ** 2).sum(1) + (extra[held] - level) ** 2))]
        far = np.sqrt(np.maximum(2 * top - 2 * (vectors[held] @ vectors[v] + extra[held] * extra[v]), 0))
        by = np.argsort(far, kind="stable")
        order[begin:end], far = held[by], far[by]
        half = (end - begin) // 2
        nodes[me][2] = v
        nodes[me][5:] = [far[0], far[half - 1], far[half], far[-1]]
        stack += [(begin, begin + half, me, 0), (begin + half, end, me, 1)]
    table = np.array(nodes, np.float64).reshape(-1, 9)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    inner = table[:, 2] >= 0
    table[inner, 2] = place[table[inner, 2].astype(np.int64)]
    return {"ids": ids[order], "rows": own[order], "vectors": vectors[order], "nodes": table, "top": np.array(top)}


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed term by term in order."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


def search(tree: dict[str, np.ndarray], query_rows: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to k rows of this shard for each query (a row that is no candidate of its own): query number, vec_id, score."""
    ids, own, vectors, nodes, top = tree["ids"], tree["rows"], tree["vectors"], tree["nodes"], float(tree["top"])
    m = len(queries)
    square = (queries * queries).sum(1)
    best = np.full((m, k), -np.inf)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    slack = 1e-9 * (1 + np.sqrt(square * top))
    products = queries @ vectors[nodes[:, 2].astype(np.int64)].T if len(nodes) > 1 else None

    def distance(who: np.ndarray, node: int) -> np.ndarray:
        return np.sqrt(np.maximum(square[who] + top - 2 * products[who, node], 0))

    def leaf(who: np.ndarray, node: int, collect: bool) -> None:
        begin, end = int(nodes[node, 0]), int(nodes[node, 1])
        scores = queries[who] @ vectors[begin:end].T
        scores[query_rows[who][:, None] == own[begin:end][None, :]] = -np.inf
        if collect:
            q, r = np.nonzero(scores >= (best[who, 0] - slack[who])[:, None])
            live = scores[q, r] > -np.inf
            pairs.append((who[q[live]], r[live] + begin))
        both = np.concatenate([best[who], scores], axis=1)
        best[who] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)

    home = np.zeros(m, np.int64)
    walking = np.arange(m)
    while len(walking):
        walking = walking[nodes[home[walking], 2] >= 0]
        for node in np.unique(home[walking]):
            who = walking[home[walking] == node]
            far = distance(who, node)
            home[who] = np.where(far <= (nodes[node, 6] + nodes[node, 7]) / 2, nodes[node, 3], nodes[node, 4]).astype(np.int64)
    for node in np.unique(home):
        leaf(np.flatnonzero(home == node), node, False)
    bound = best[:, 0].copy()  # a lower bound of the k-th score: what the first leaf gave
    best[:] = -np.inf
    stack = [(0, np.arange(m))]
    while stack:
        node, who = stack.pop()
        if nodes[node, 2] < 0:
            leaf(who, node, True)
            continue
        least = np.maximum(bound[who], best[who, 0]) - slack[who]
        reach = factor * np.sqrt(np.maximum(square[who] + top - 2 * least, 0))
        reach = np.where(np.isfinite(least), reach, np.inf)
        far = distance(who, node)
        for side in (0, 1):
            near, last = nodes[node, 5 + 2 * side], nodes[node, 6 + 2 * side]
            enters = who[(far - reach <= last + 1e-9) & (far + reach >= near - 1e-9)]
            if len(enters):
                stack.append((int(nodes[node, 3 + side]), enters))
    q, r = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    score = np.concatenate([exact(vectors[r[a : a + 100_000]], queries[q[a : a + 100_000]]) for a in range(0, len(q), 100_000)] or [np.zeros(0)])
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    first = np.searchsorted(q, q)
    kept = np.arange(len(q)) - first < k
    return q[kept], ids[r[kept]], score[kept]


def _blob(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_id, row and vector."""
    flat = table.column("vector").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return table.column("vec_id").to_numpy(), table.column("row").to_numpy(), flat.flatten().to_numpy().reshape(table.num_rows, -1)


def _walker(k: int, factor: float):
    """Of rows sorted by unit, the tree of each before its blocks: the neighbours of the blocks' queries in that tree."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for is_block, data in zip(batch.column("is_block").to_pylist(), batch.column("data"), strict=True):
                found = dict(np.load(io.BytesIO(data.as_py())))
                if not is_block:
                    tree = found
                    continue
                q, ids, score = search(tree, found["rows"], found["vectors"], k, factor)
                yield pa.RecordBatch.from_arrays([pa.array(found["ids"][q]), pa.array(found["rows"][q]), pa.array(ids), pa.array(score)], ["query_id", "query_row", "vec_id", "score"])

    return walk


def nearest(vectors: DataFrame, is_query, k: int = 20, factor: float = 1.0, shard_rows: int = SHARD) -> DataFrame:
    """The k nearest of every row for which ``is_query`` (a condition on vec_id); columns query_id, rank, vec_id, score.

    ``vectors``: vec_id and embedding.  Everything is by length of the vectors, in tables of a row per length.
    """
    bound_batches(vectors.sparkSession)
    wide = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).where("vec_id is not null and size(vector) > 0")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    wide = wide.where(sound & F.exists("vector", lambda x: x != 0))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    asks = F.coalesce(is_query, F.lit(False)).alias("asks")
    base = materialize(wide.select("vec_id", "vector", F.size("vector").alias("length"), norm.alias("norm"), asks, F.monotonically_increasing_id().alias("row")), "vectors")
    whole = F.ceil(F.count("*") / shard_rows).cast("long")
    sizes = materialize(base.groupBy("length").agg(whole.alias("shards"), F.max("norm").alias("top"), F.ceil(F.count_if("asks") / BLOCK).cast("long").alias("blocks")), "vector-lengths")

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows, own = _columns(table)
        top = float(pc.max(table.column("top")).as_py())
        return pa.table({"length": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()), "tree": pa.array([_blob(**build(ids, own, top, rows))], pa.binary())})

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows, own = _columns(table)
        return pa.table({"length": pa.array([key[0].as_py()], pa.int32()), "b": pa.array([key[1].as_py()], pa.int64()), "block": pa.array([_blob(ids=ids, rows=rows, vectors=own)], pa.binary())})

    dealt = base.select("vec_id", "row", "vector", "length", "asks").join(sizes, "length")
    shard = F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard")
    trees = materialize(dealt.select("vec_id", "row", "vector", "length", "top", shard).groupBy("length", "shard").applyInArrow(plant, "length int, shard long, tree binary"), "vantage-trees")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).alias("b")
    asking = materialize(dealt.where("asks").select("vec_id", "row", "vector", "length", block).groupBy("length", "b").applyInArrow(gather, "length int, b long, block binary"), "vector-blocks")
    # a unit of work is a tree and a group of blocks
    last = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    groups = F.ceil(F.col("blocks") / GROUP).cast("long")
    told = trees.join(sizes.where("blocks > 0"), "length").select("length", "shard", last(groups).alias("g"), F.lit(False).alias("is_block"), F.col("tree").alias("data"))
    asked = asking.join(sizes, "length").select("length", last(F.col("shards")).alias("shard"), F.floor(F.col("b") / GROUP).cast("long").alias("g"), F.lit(True).alias("is_block"), F.col("block").alias("data"))
    units = told.union(asked).repartition("length", "shard", "g").sortWithinPartitions("length", "shard", "g", "is_block")
    met = units.select("is_block", "data").mapInArrow(_walker(k, factor), "query_id long, query_row long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


ORACLE = """
with v as (
  select vec_id, embedding::double[] as v, row_number() over () as n from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (
  select q.n, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
  from v q join v c on q.vec_id % 20 = 0 and c.n <> q.n and len(c.v) = len(q.v)),
r as (
  select *, row_number() over (partition by n order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
