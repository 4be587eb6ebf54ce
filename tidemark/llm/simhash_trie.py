"""Near-duplicates: 64-bit SimHash fingerprints linked by a binary-trie self-join.

Fingerprints that differ in at most ``budget`` = 3 bits agree on at least one of
four blocks of 16 bits.  So every distinct fingerprint goes to four buckets, one
per block, and each bucket is joined with itself over its trie: a sorted array is
the trie, a node is a range of it, and pairs of nodes walk down together.  A pair
of nodes carries the number of bits in which its prefixes differ and is dropped
once that exceeds the budget; small nodes are compared directly.  A bucket larger
than ``hot`` is split by a second level of blocks (four of 12 of its other 48
bits, where the same argument holds), so that no task joins an unbounded group.

A bucket reports its links as stars (each fingerprint with the smallest one it is
connected to there), so copies never expand into pairs; stars of all buckets are
then joined into components (see ``components``).

Edge cases: texts without words have fingerprint zero and link like any other;
null text counts as empty; equal texts share a fingerprint and so a component; a
null doc_id is a document like any other, and a component of null doc_ids only has
a null component_id; rows of equal doc_id are separate documents; an empty table
gives an empty table; clashing column names of the input don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import attach, connected, local_roots
from tidemark.shared import bound_batches, materialize

SEED = 42
BITS = 64
LEAF = 24  # pairs of nodes with at most so many pairs of fingerprints are compared directly
FRONTIER = 400_000  # pairs of nodes walked at once


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the word shingles of a text."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z only, and white space is 9 to 13 and 32 only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(words[i : i + width]), SEED) for i in range(n)), ">u8", n)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(0)), np.uint64, len(batch)).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], [*batch.schema.names[1:], "fp"])


def with_fingerprints(docs: DataFrame, text: str, keep: list) -> DataFrame:
    """The columns ``keep`` and ``fp`` (long, the fingerprint's bits)."""
    bound_batches(docs.sparkSession)
    chosen = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    return chosen.mapInArrow(_fingerprints, T.StructType([*chosen.schema.fields[1:], T.StructField("fp", T.LongType())]))


def trie_links(fps: np.ndarray, groups: np.ndarray, budget: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices within ``budget`` bits and one group, connected like all such pairs.

    ``fps`` (unsigned 64-bit) is sorted within ``groups`` (runs of equal numbers) and has no repeats there.
    """
    n = len(fps)
    edges = np.flatnonzero(np.diff(groups)) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [n]])
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    left_out, right_out, held = [], [], 0
    stack = [(BITS - 1, lo[k : k + FRONTIER], hi[k : k + FRONTIER], lo[k : k + FRONTIER], hi[k : k + FRONTIER], np.zeros(len(lo[k : k + FRONTIER]), np.int8)) for k in range(0, len(lo), FRONTIER)]
    ones_at: dict[int, np.ndarray] = {}
    while stack:
        bit, a0, a1, b0, b1, d = stack.pop()
        na, nb = a1 - a0, b1 - b0
        small = (na * nb <= LEAF) | (bit < 0)
        if small.any():
            p0, q0, pn, qn = a0[small], b0[small], na[small], nb[small]
            pairs = pn * qn
            which = np.repeat(np.arange(len(pairs)), pairs)
            k = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            i, j = p0[which] + k // qn[which], q0[which] + k % qn[which]
            near = (i < j) & (np.bitwise_count(fps[i] ^ fps[j]) <= budget)
            left_out.append(i[near])
            right_out.append(j[near])
            held += int(near.sum())
            if held > 2_000_000:  # keep a forest of what is linked so far
                root = local_roots(n, np.concatenate(left_out), np.concatenate(right_out))
                own = np.flatnonzero(root != np.arange(n))
                left_out, right_out, held = [root[own]], [own], len(own)
            a0, a1, b0, b1, d = (x[~small] for x in (a0, a1, b0, b1, d))
        if not len(a0):
            continue
        if bit not in ones_at:
            ones_at[bit] = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        ones = ones_at[bit]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])  # where the bit turns to one
        same = a0 == b0
        new = [
            (a0, am, b0, bm, d),
            (am, a1, bm, b1, d),
            (a0, am, bm, b1, d + 1),
            (am[~same], a1[~same], b0[~same], bm[~same], d[~same] + 1),
        ]
        nxt = [np.concatenate(x) for x in zip(*new, strict=True)]
        live = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3]) & (nxt[4] <= budget) & ~((nxt[0] == nxt[2]) & (nxt[1] - nxt[0] == 1))
        nxt = [x[live] for x in nxt]
        for k in range(0, len(nxt[0]), FRONTIER):
            stack.append((bit - 1, *(x[k : k + FRONTIER] for x in nxt)))
    none = np.zeros(0, np.int64)
    return (np.concatenate(left_out), np.concatenate(right_out)) if left_out else (none, none)


def _star_rows(fps: np.ndarray, groups: np.ndarray, budget: int) -> pa.RecordBatch:
    left, right = trie_links(fps, groups, budget)
    root = local_roots(len(fps), left, right)
    own = np.flatnonzero(root != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(signed[root[own]])], ["a", "b"])


def _joiner(budget: int, hold: int = 200_000):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = fps = None
        for batch in batches:  # sorted by bucket and fingerprint; whole buckets are joined, several at once
            g, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            groups, fps = (g, f) if groups is None else (np.concatenate([groups, g]), np.concatenate([fps, f]))
            end = int(np.searchsorted(groups, groups[-1]))  # the last bucket may go on
            if end >= hold:
                yield from map(lambda x: _star_rows(*x, budget), [_sorted(fps[:end], groups[:end])])
                groups, fps = groups[end:], fps[end:]
        if groups is not None and len(groups):
            yield _star_rows(*_sorted(fps, groups), budget)

    return join


def _sorted(fps: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spark sorted the signed numbers; a trie needs them unsigned."""
    order = np.lexsort((fps, groups))
    return fps[order], groups[order]


def links(fps: DataFrame, budget: int = 3, hot: int = 20_000) -> DataFrame:
    """Stars (a, b) that connect the distinct fingerprints ``fp`` within ``budget`` bits of each other."""
    if budget != 3:
        raise ValueError("four blocks find up to three differing bits")
    blocks = [F.shiftrightunsigned("fp", 16 * b).bitwiseAND(0xFFFF) + (b << 16) for b in range(4)]
    keyed = fps.select("fp", F.explode(F.array(*blocks)).alias("key"))
    sizes = keyed.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("large"))
    keyed = keyed.join(sizes, "key", "left")
    # the other 48 bits of a large bucket, as four blocks of 12, each with its number
    b = F.shiftright("key", 16).cast("int")
    rest = F.when(b == 0, F.shiftrightunsigned("fp", 16))
    for k in (1, 2, 3):
        low = F.col("fp").bitwiseAND((1 << (16 * k)) - 1)
        high = F.shiftrightunsigned("fp", 16 * k + 16) if k < 3 else F.lit(0).cast("long")
        rest = rest.when(b == k, low.bitwiseOR(F.shiftleft(high, 16 * k)))
    keyed = keyed.withColumn("rest", rest)
    second = [(F.col("key") + 1) * (1 << 20) + (s + 1) * (1 << 16) + F.shiftrightunsigned("rest", 12 * s).bitwiseAND(0xFFF) for s in range(4)]
    key = F.explode(F.when(F.col("large"), F.array(*second)).otherwise(F.array(F.col("key").cast("long"))))
    dealt = keyed.select(key.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_joiner(budget), "a long, b long")


def link_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list | None = None) -> DataFrame:
    """doc_id, the columns ``carry``, fp, component_id and ``first``: true for one document of each component, that of the smallest doc_id."""
    carry = [F.col(c) if isinstance(c, str) else c for c in carry or []]
    slim = with_fingerprints(docs, text, [F.col(doc_id).cast("long").alias("__doc"), *carry])
    base = materialize(slim.withColumn("__row", F.monotonically_increasing_id()), "simhash")
    mine = F.struct(F.col("__doc").isNull().alias("none"), F.col("__doc").alias("doc"), F.col("__row").alias("row"))
    nodes = base.groupBy("fp").agg(F.min(mine).alias("least"))
    roots = connected(materialize(links(nodes.select("fp")), "simhash-links"))
    placed = materialize(nodes.join(roots.select(F.col("a").alias("fp"), "b"), "fp", "left").withColumn("root", F.coalesce("b", "fp")).drop("b"), "simhash-nodes")
    components = placed.groupBy("root").agg(F.min("least").alias("best"))
    of = attach(placed.select("fp", "root"), components, "root").select("fp", F.col("best.doc").alias("component_id"), F.col("best.row").alias("best_row"))
    joined = attach(base, materialize(of, "simhash-components"), "fp").withColumn("first", F.col("__row") == F.col("best_row"))
    return joined.select(F.col("__doc").alias("doc_id"), *[c for c in base.columns if c not in ("__doc", "__row", "fp")], "fp", "component_id", "first")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return link_documents(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
