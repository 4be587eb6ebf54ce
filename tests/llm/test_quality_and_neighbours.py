import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_mil as q
from tidemark.llm import vptree as v

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scores = {r.doc_id: r for r in q.op1_quality(spark, SF).collect()}
    assert len(scores) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 for r in scores.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for d, r in scores.items())
    held = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if scores[r.doc_id].held_out]
    right = [scores[r.doc_id].predicted == r.quality for r in held]
    assert len(held) > 60 and np.mean(right) >= 0.95


def test_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.standard_normal((k, q.FEATURES)).astype(np.float32) for k in (1, 3, 2, 5)]
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    few, many = (q.train(bags, labels, epochs=n, batch=4) for n in (1, 200))

    def loss(model):
        out = []
        for b in bags:
            h, e = q.encode(model, b)
            a = np.exp(e - e.max())
            out.append(1 / (1 + np.exp(-((a / a.sum()) @ h @ model["c"] + model["c0"][0]))))
        return -np.mean(labels * np.log(out) + (1 - labels) * np.log(1 - np.array(out)))

    assert loss(many) < 0.1 < loss(few)


def test_scores_read_all_passages_alike(monkeypatch):
    rng = random.Random(1)
    model = q.train([np.random.default_rng(k).standard_normal((2, q.FEATURES)).astype(np.float32) for k in range(8)], np.arange(8) % 2.0)
    texts = [None, "", " ", "a", "é" * 301, *("".join(rng.choice("abc !#é\n") for _ in range(n)) for n in (599, 600, 601, 5000))]
    alone = [q.score_texts(model, [t])[0] for t in texts]
    together = q.score_texts(model, texts)
    monkeypatch.setattr(q, "PIECE", 2 * q.PASSAGE)
    assert np.allclose(alone, together) and np.allclose(q.score_texts(model, texts), together) and len(q.score_texts(model, [])) == 0


def test_scores_equal_a_passage_by_passage_computation(spark):
    """The model of the query, applied again in plain loops."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = q.fit(docs, labels)
    got = {r.doc_id: r.score for r in q.op1_quality(spark, SF).collect()}
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    longest = max(rows, key=lambda r: len(r.text or ""))
    assert len(longest.text.encode()) > 30 * q.PASSAGE
    for r in [*rows[::40], longest]:
        raw, hidden, weight = (r.text or "").encode(), [], []
        for k in range(0, max(1, len(raw)), q.PASSAGE):
            part = raw[k : k + q.PASSAGE]
            x = (q.features(part, np.array([len(part)]))[0] - model["mean"]) / model["scale"]
            h = np.tanh(x @ model["W"] + model["b"])
            gate = np.tanh(h @ model["V"]) * (1 / (1 + np.exp(-(h @ model["U"]))))
            hidden.append(h)
            weight.append(np.exp(gate @ model["w"]))
        z = sum(a * h for a, h in zip(weight, hidden, strict=True)) / sum(weight)
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-(z @ model["c"] + model["c0"][0]))), abs=1e-6)


def test_training_takes_rows_whole_up_to_its_bounds(spark, monkeypatch):
    """Every passage of a chosen row is there, and no row is cut to fit."""
    docs = spark.createDataFrame([(i, "ab " * (700 if i == 3 else 20)) for i in range(30)] + [(40, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(40, 0), (41, 1)], "doc_id long, quality int")
    bags = {}
    monkeypatch.setattr(q, "train", lambda b, y, **_: bags.update(n=[len(x) for x in b]))
    free = [i for i in [*range(30), 40] if zlib.crc32(str(i).encode()) % 4 != 2]
    q.fit(docs, labels)
    assert sorted(bags["n"]) == sorted(4 if i == 3 else 1 for i in free)
    q.fit(docs, labels, train_passages=7)
    assert sum(bags["n"]) <= 7 and set(bags["n"]) <= {1, 4} and len(bags["n"]) >= 4
    q.fit(docs, labels, train_docs=5)
    assert len(bags["n"]) <= 5
    assert q.fit(docs, labels, train_passages=0) is None


def test_quality_of_edge_cases(spark, texts, frame_of):
    docs = frame_of(texts, score="clash")
    none = q.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert none is None and {r.score for r in q.score_documents(docs, none).collect()} == {0.5}
    model = q.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (10**6, 1)], "doc_id long, quality int"))
    got = q.score_documents(docs, model)
    assert got.count() == len(texts) and got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert got.where("doc_id = 25").select("score").distinct().count() == 1
    assert q.score_documents(frame_of([]), model).collect() == []


def product(x, y):
    """Term by term; Python's own sum() compensates."""
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


def brute(rows, k, query):
    kept = [(i, x) for i, x in rows if i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    out = []
    for a, (i, x) in enumerate(kept):
        if query(i):
            near = sorted((-product(x, y), j) for b, (j, y) in enumerate(kept) if b != a and len(y) == len(x))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def vectors():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 3) for _ in range(4)]) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # one vector, many copies
    rows += [(40, rows[40][1]), (40, [9.0, 0.0, 0.0, 0.0]), (61, rows[60][1])]  # repeated vec_ids, also of queries
    rows += [(3000 + i, [rng.gauss(0, 1) for _ in range(2 + i % 2)]) for i in range(90)]  # other lengths
    return rows + [rows[3], (5, [9.0, 0.0, 0.0, 0.0]), (2000, None), (2020, [0.0] * 4), (2040, [1.0, None, 0.0, 0.0]), (2060, [1.0, float("nan"), 0.0, 0.0]), (2080, [float("inf"), 1.0, 0.0, 0.0]), (2100, [1.0]), (2120, []), (None, [1.0] * 4)]


@pytest.mark.parametrize("shard_rows, block, group", [(16_384, 256, 16), (300, 8, 2)])
def test_exact_search(spark, monkeypatch, shard_rows, block, group):
    """Several shards, blocks and groups; the extra columns clash with names used inside."""
    monkeypatch.setattr(v, "BLOCK", block)
    monkeypatch.setattr(v, "GROUP", group)
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("vector", "norm", "row", "length", "shard", "score", "rank", "query_id", "asks")})
    got = sorted(tuple(r) for r in v.nearest(df, F.col("vec_id") % 20 == 0, 7, shard_rows=shard_rows).collect())
    assert got == brute(vectors(), 7, lambda i: i % 20 == 0)


def test_trees_prune_and_relaxed_factors_keep_recall():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    rows = centres[rng.integers(0, 40, 6000)] + 0.1 * rng.standard_normal((6000, 16))
    tree = v.build(np.arange(6000), rows, float((rows * rows).sum(1).max()))
    asked = np.arange(0, 6000, 50)
    want = {(a, b) for a in asked for b in [j for j in np.argsort(-(rows @ rows[a]), kind="stable") if j != a][:20]}
    for factor, least in ((1.0, 1.0), (0.6, 0.9)):
        qn, ids, _ = v.search(tree, asked, rows[asked], 20, factor)
        found = set(zip(asked[qn].tolist(), ids.tolist(), strict=True))
        assert len(found & want) >= least * len(want) and len(qn) == 20 * len(asked)


def test_few_and_no_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert v.nearest(make([]), F.col("vec_id") >= 0).collect() == []
    assert v.nearest(make([(1, [1.0, 2.0])]), F.col("vec_id") >= 0).collect() == []
    assert [tuple(r) for r in v.nearest(make([(1, [1.0, 0.0]), (2, [2.0, 0.0])]), F.col("vec_id") == 1).collect()] == [(1, 1, 2, 2.0)]
