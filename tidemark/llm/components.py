"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import materialize, remove


#: A key of more rows than this is a hub, and its rows are joined where they lie.
HUB = 100


def attach(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` (a written table) joined with ``table``, which has one row for each ``key``.

    Rows of a hub would meet in one task.  There are fewer hubs than rows / ``HUB``; their rows of
    ``table`` are written, so that the optimizer knows their size and sends them to
    wherever the hubs' rows are.  All other rows are dealt by key.
    """
    others = [c for c in table.columns if c != key]
    many = rows.groupBy(key).count().where(F.col("count") > HUB).select(key)
    hubs = materialize(table.join(many, key).select(key, F.struct(*others).alias("__hub")), "hubs")
    marked = rows.join(hubs, key, "left")
    apart = marked.where("__hub is not null").select(*rows.columns, "__hub.*")
    return apart.unionByName(marked.where("__hub is null").drop("__hub").join(table, key).select(*rows.columns, *others))


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node links its larger neighbours (or itself and its smaller ones) to the smallest of them and itself."""
    if larger:
        sided = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sided = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sided.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = attach(sided, least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) per node a that is not the smallest of its component: b is the smallest.

    ``edges`` has the integer columns a and b and is a written table.  Each round is
    written to the shared folder and read twice by the next; two numbers per round come to
    the driver.  The rounds grow with the logarithm of the longest chain; should
    ``rounds`` not do, an error is raised and nothing is returned.
    """
    state = None
    for _ in range(rounds):
        before = edges
        half = materialize(_stars(before, larger=True), "component-edges")
        edges = materialize(_stars(half, larger=False), "component-edges")
        remove(before)
        remove(half)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if now == state:
            return edges
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, for nodes 0 to n-1 in memory."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
