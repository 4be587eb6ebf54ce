import hashlib
import math
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import curriculum, hash_ring


def brute_shards(keys, shards=8, virtual_nodes=64, load=1.0):
    """The walk row by row: the shard of each key, in the order of ``keys``."""
    points = hash_ring.ring_points(shards, virtual_nodes)
    places = [p for p, _ in points]
    hashes = [int(hashlib.md5(("null" if k is None else str(k)).encode()).hexdigest()[:15], 16) for k in keys]
    arc = [bisect_left(places, h >> 44) % len(points) for h in hashes]
    n = len(keys)
    room = [n // shards + (s < n % shards) if load == 1 else math.ceil(load * n / shards) for s in range(shards)]
    out, waiting = [None] * n, []
    # ring order from the start of arc 0, which lies behind the last point
    for i in sorted(range(n), key=lambda i: (arc[i], (hashes[i] >> 44) <= places[-1], hashes[i], i)):
        shard = points[arc[i]][1]
        if room[shard]:
            room[shard] -= 1
            out[i] = shard
        else:
            waiting.append(i)
    for i in waiting:
        at = arc[i]
        while not room[points[at][1]]:
            at = (at + 1) % len(points)
        room[points[at][1]] -= 1
        out[i] = points[at][1]
    return out


@pytest.mark.parametrize("n, shards, load", [(0, 8, 1), (1, 8, 1), (500, 8, 1), (777, 3, 1), (600, 5, 1.2)])
def test_ring_equals_the_row_by_row_walk(spark, n, shards, load):
    rng = random.Random(n)
    keys = [rng.choice([None, rng.randrange(10**6), 5]) if rng.random() < 0.3 else rng.randrange(10**9) for _ in range(n)]
    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate(keys)], "doc_id long, i int, shard string")
    got = hash_ring.shard_rows(df, "doc_id", [F.col("i")], shards, load=load).collect()
    want = brute_shards(keys, shards, load=load)
    assert Counter((r.doc_id, r.shard) for r in got) == Counter(zip(keys, want, strict=True))
    counts = Counter(r.shard for r in got)
    if load == 1:
        assert max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts.get(s, 0)))
    with pytest.raises(ValueError):
        hash_ring.shard_rows(df, "doc_id", [], load=0.5)


def test_a_third_of_all_rows_with_one_key(spark, monkeypatch):
    """Its slot is cut into parts; the law holds, and no other key moves."""
    monkeypatch.setattr(hash_ring, "HOT_ROWS", 20)
    rng = random.Random(2)
    keys = [None if i % 3 == 0 else rng.randrange(10**9) for i in range(1200)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "doc_id long, i int").repartition(5)
    got = hash_ring.shard_rows(df, "doc_id", [F.col("i")])
    assert Counter((r.doc_id, r.shard) for r in got.collect()) == Counter(zip(keys, brute_shards(keys), strict=True))
    counts = Counter(r.shard for r in got.collect())
    assert len(counts) == 8 and set(counts.values()) == {150} and got.select("shard", "slot").distinct().count() == 1200


def test_few_rows_move_when_a_shard_is_added():
    """The ideal is a ninth; full shards pass rows on, and with room to spare they hardly do."""
    keys = list(range(4000))
    moved = {}
    for load in (1, 1.25):
        a, b = brute_shards(keys, 8, load=load), brute_shards(keys, 9, load=load)
        moved[load] = sum(x != y for x, y in zip(a, b, strict=True)) / len(keys)
    assert moved[1.25] < 0.14 and moved[1] < 0.2


def test_op5(spark, texts, frame_of, tmp_path):
    import zlib

    frame_of(texts, shard=1, slot=2).write.parquet(str(tmp_path / "documents.parquet"))
    got = hash_ring.op5_sharding(spark, str(tmp_path))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got.collect()) == want


def brute_targets(sizes):
    """Resharing as told: a source at its limit stops, its excess goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
        open_ = {s for s in open_ if target[s] < 2 * sizes[s]}
    return target


def mixed_table(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, target string, ordinal int")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))


def sample():
    rng = random.Random(3)
    rows = [(i, rng.choice(["b", "a", "é", "~", None, "hot", "hot", "hot", "hot"]), rng.choice(["w " * rng.randint(0, 40), None, "", "\x0b a\tb c "]), "x", 1) for i in range(300)]
    return rows + [rows[5], (None, "a", "one two", "x", 1), (777, "zero", "", "x", 1), (778, "a", "long " * 5000, "x", 1)]


def test_mix_meets_targets(spark, tmp_path):
    rows = sample()
    mixed_table(spark, tmp_path, rows)
    got = curriculum.op6_mixing(spark, str(tmp_path)).collect()
    source = {r[0]: r[1] for r in rows}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        assert (r.position_2 is None) == (r.taken <= r.size) and (r.place is None) == (r.taken == 0)
    uses = sorted((p, n) for r in got for p, n in ((r.position, r.place), (r.position_2, r.place_2)) if p is not None)
    assert sorted(n for _, n in uses) == list(range(len(uses))) and [p for _, p in sorted((n, p) for p, n in uses)] == [p for p, _ in uses]
    want = brute_targets(sizes)
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w]) for _, _, t, _, _ in rows)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 0.5
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_equals_its_sql(spark, tmp_path):
    mixed_table(spark, tmp_path, [r for r in sample() if r[0] is not None])
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = curriculum.op6_mixing(spark, str(tmp_path))
    want = con.sql(curriculum.ORACLE)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_positions_follow_the_schedule(spark, tmp_path):
    mixed_table(spark, tmp_path, [(i, f"s{i % 3}", "w " * 10, "x", 1) for i in range(3000)])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rows = curriculum.schedule(curriculum.mix(docs)).select("source", "position").collect()
    early = Counter(r.source for r in rows if r.position < 0.25)
    total = Counter(r.source for r in rows)
    # sources ask early (2 to 0.5), evenly, and late (0.5 to 2)
    assert early["s0"] / total["s0"] > 0.3 > 0.27 > early["s1"] / total["s1"] > 0.23 > 0.2 > early["s2"] / total["s2"]
    positions = [r.position for r in rows]
    assert positions == sorted(positions)


def test_equal_ids_and_clashing_columns(spark):
    """Rows of one doc_id are told apart by their texts, so the same ones are taken however the table is dealt."""
    rows = [(7, "s", "w " * (i % 9), i, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, target string")
    take = lambda df: sorted((r.text, r.size, r.taken, tuple(r.positions)) for r in curriculum.mix(df, share=0.5).collect())
    assert take(docs.repartition(3)) == take(docs.repartition(7, "size")) and sum(x[2] for x in take(docs)) == sum(i % 9 for i in range(400)) // 2


def test_empty(spark, tmp_path):
    mixed_table(spark, tmp_path, [])
    assert curriculum.op6_mixing(spark, str(tmp_path)).collect() == []
