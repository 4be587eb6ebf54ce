"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes; only the bag has a label.
Each passage is encoded (character classes, pairs of classes, hashed byte
trigrams, repetition of words; then a learned layer), a gated attention weighs
the passages, and a logistic layer scores the weighted sum::

    h_k = tanh(W x_k + b)      a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))
    score = sigmoid(c . sum_k a_k h_k + c0)

Training uses a bounded sample of labelled rows, the first in the order of a hash of
doc_id: at most ``train_docs`` of them, and only as many as have ``train_passages``
passages together (both parameters of :func:`fit`), since the driver trains.  Every
passage of a chosen row is encoded, as in scoring, which reads every passage of every
document, in pieces of ``PIECE`` bytes.

Edge cases: null and empty texts are one empty passage and get a score; labels
that are null, or without a document, are not used; without any label the score
is 0.5 throughout; repeated rows get equal scores; an empty table gives an empty
table; a column of the input named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import bound_batches

PASSAGE = 600
PIECE = 1000 * PASSAGE
TRAIN_DOCS = 4000
TRAIN_PASSAGES = 60_000
CUTOFF = 0.7
HIDDEN, GATE = 32, 16
TRIGRAMS = 128


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes: fine ones (each ASCII punctuation by itself) and eight coarse ones."""
    fine, coarse = np.zeros(256, np.int64), np.zeros(256, np.int64)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b) if b < 128 else ""
        if b in marks:
            fine[b], coarse[b] = 8 + marks.index(b), 4 if c in ".,;:?'\"()-" else 5
        else:
            k = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c == " " else 4 if c in "\t\n\r\v\f" and c else 5 if b < 128 else 6 if b < 192 else 7
            fine[b], coarse[b] = k, (0, 1, 2, 3, 6, 5, 7, 7)[k]
    return fine, coarse


FINE, COARSE = _classes()
N_FINE = int(FINE.max()) + 1
FEATURES = N_FINE + 64 + TRIGRAMS + 4
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], np.uint64)


def features(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """A row per passage; passage k is the next sizes[k] bytes of ``data``."""
    n, m = len(data), len(sizes)
    out = np.zeros((m, FEATURES), np.float32)
    if n == 0:
        return out
    text = np.frombuffer(data, np.uint8)
    of = np.repeat(np.arange(m), sizes)
    share = 1.0 / np.maximum(sizes, 1)[:, None]
    out[:, :N_FINE] = np.sqrt(np.bincount(of * N_FINE + FINE[text], minlength=m * N_FINE).reshape(m, N_FINE) * share)
    coarse = COARSE[text]
    pair = (of[:-1] * 64 + coarse[:-1] * 8 + coarse[1:])[of[:-1] == of[1:]]  # within a passage
    out[:, N_FINE : N_FINE + 64] = np.sqrt(np.bincount(pair, minlength=m * 64).reshape(m, 64) * share)
    wide = text.astype(np.uint32)
    tri = ((wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA6B)) ^ (wide[2:] * np.uint32(0xC2B2AE35))) >> np.uint32(25)
    at = N_FINE + 64
    inner = of[:-2] == of[2:]
    out[:, at : at + TRIGRAMS] = np.sqrt(np.bincount((of[:-2] * TRIGRAMS + tri)[inner], minlength=m * TRIGRAMS).reshape(m, TRIGRAMS) * share)
    at += TRIGRAMS
    space = (text == 32) | ((text >= 9) & (text <= 13))
    begins = ~space
    begins[1:] &= space[:-1] | (of[1:] != of[:-1])
    starts = np.flatnonzero(begins)
    if len(starts):
        place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n))) if starts[0] == 0 else np.arange(n) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, n)))])
        value = np.where(space, np.uint64(0), (text.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63])
        words, own = np.add.reduceat(value, starts), of[starts]
        count = np.bincount(own, minlength=m)
        same = (words[1:] == words[:-1]) & (own[1:] == own[:-1])
        out[:, at] = np.bincount(own[1:][same], minlength=m) / np.maximum(count, 1)
        mixed = np.sort((own.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
        new = np.append(True, mixed[1:] != mixed[:-1])
        out[:, at + 1] = np.bincount((mixed[new] >> np.uint64(40)).astype(np.int64), minlength=m) / np.maximum(count, 1)
        out[:, at + 2] = (np.bincount(of[~space], minlength=m) / np.maximum(count, 1)) / 10
    out[:, at + 3] = sizes / PASSAGE
    return out


def passage_sizes(n: int) -> np.ndarray:
    """Sizes of the passages of a text of n bytes: at least one passage."""
    return np.diff(np.append(np.arange(0, max(n, 1), PASSAGE), n))


def initial(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
    return {"W": normal(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": normal(HIDDEN, GATE), "U": normal(HIDDEN, GATE), "w": normal(GATE), "c": normal(HIDDEN), "c0": np.zeros(1)}


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 120, rate: float = 0.01, decay: float = 1e-3, batch: int = 256) -> dict[str, np.ndarray] | None:
    """Fit by Adam on the log loss of the bags; None without labels."""
    if not bags:
        return None
    everything = np.concatenate(bags)
    mean, scale = everything.mean(0, dtype=np.float64), everything.std(0, dtype=np.float64) + 0.02
    bags = [((b - mean) / scale).astype(np.float32) for b in bags]
    p = initial()
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    rng = np.random.default_rng(1)
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            x, y = np.concatenate([bags[i] for i in chosen]), labels[chosen]
            sizes = np.array([len(bags[i]) for i in chosen])
            edges, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            h = np.tanh(x @ p["W"] + p["b"])
            tv, su = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
            e = (tv * su) @ p["w"]
            a = np.exp(e - np.maximum.reduceat(e, edges)[of])
            a /= np.add.reduceat(a, edges)[of]
            z = np.add.reduceat(a[:, None] * h, edges, axis=0)
            out = (1 / (1 + np.exp(-(z @ p["c"] + p["c0"]))) - y) / len(y)
            g = {"c": z.T @ out, "c0": np.array([out.sum()])}
            dz = out[:, None] * p["c"]
            da = (dz[of] * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, edges)[of])
            g["w"] = (tv * su).T @ de
            dg = de[:, None] * p["w"]
            dv, du = dg * su * (1 - tv * tv), dg * tv * su * (1 - su)
            g["V"], g["U"] = h.T @ dv, h.T @ du
            dh = (a[:, None] * dz[of] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            g["W"], g["b"] = x.T @ dh, dh.sum(0)
            step += 1
            for name in p:
                grad = g[name] + decay * p[name] / len(p[name]) ** 0.5
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                p[name] = p[name] - rate * (1 - epoch / epochs) * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def encode(model: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages and their attention before the softmax."""
    h = np.tanh(((x - model["mean"]) / model["scale"]) @ model["W"] + model["b"])
    return h, (np.tanh(h @ model["V"]) / (1 + np.exp(-(h @ model["U"])))) @ model["w"]


def score_texts(model: dict[str, np.ndarray] | None, texts: list[str | None]) -> np.ndarray:
    """The score of each text, from all its passages."""
    if model is None:
        return np.full(len(texts), 0.5)
    encoded, attention, counts = [], [], np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    sizes: list[np.ndarray] = []
    filled = 0

    def flush() -> None:
        nonlocal held, sizes, filled
        if sizes:
            h, e = encode(model, features(b"".join(held), np.concatenate(sizes)))
            encoded.append(h)
            attention.append(e)
        held, sizes, filled = [], [], 0

    for i, text in enumerate(texts):
        raw = (text or "").encode()
        for k in range(0, max(1, len(raw)), PIECE):
            part = raw[k : k + PIECE]
            held.append(part)
            sizes.append(passage_sizes(len(part)))
            counts[i] += len(sizes[-1])
            filled += len(part)
            if filled >= PIECE:
                flush()
    flush()
    if not len(texts):
        return np.zeros(0)
    h, e = np.concatenate(encoded), np.concatenate(attention)
    edges, of = np.cumsum(counts) - counts, np.repeat(np.arange(len(texts)), counts)
    a = np.exp(e - np.maximum.reduceat(e, edges)[of])
    a /= np.add.reduceat(a, edges)[of]
    # rounded, as the last bits of a matrix product depend on the other rows
    return np.round(1 / (1 + np.exp(-(np.add.reduceat(a[:, None] * h, edges, axis=0) @ model["c"] + model["c0"][0]))), 9)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(2).to_pylist():
            raw = (text or "").encode()
            parts = [raw[k : k + PIECE] for k in range(0, max(1, len(raw)), PIECE)]
            out.append(b"".join(features(p, passage_sizes(len(p))).astype(np.float16).tobytes() for p in parts))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "label", "bag"])


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES) -> dict[str, np.ndarray] | None:
    """A model from labelled documents outside the held-out fold; the sizes of ``train_docs`` rows and the features of ``train_passages`` passages come to the driver."""
    spark = docs.sparkSession
    bound_batches(spark)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("label")]
    first = usable.select(F.col("doc_id").cast("long"), F.col(label).cast("double").alias("label")).orderBy(*order).limit(train_docs)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    passages = F.greatest(F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / PASSAGE), F.lit(1))
    sized = texts.join(F.broadcast(first), "doc_id").groupBy("doc_id", "label").agg(F.sum(passages).alias("n"))
    left, chosen = train_passages, []
    for r in sized.orderBy(*order).collect():
        if r.n <= left:  # a row is taken whole or not at all
            left -= r.n
            chosen.append((r.doc_id, r.label))
    if not chosen:
        return None
    texts = texts.join(F.broadcast(spark.createDataFrame(chosen, "doc_id long, label double")), "doc_id").select("doc_id", "label", "text")
    rows = sorted(texts.mapInArrow(_bags, "doc_id long, label double, bag binary").collect(), key=lambda r: (r[0], r[1], bytes(r[2])))
    bags = [np.frombuffer(r.bag, np.float16).astype(np.float32).reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([float(r.label > 0) for r in rows]))


def score_documents(docs: DataFrame, model: dict[str, np.ndarray] | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``."""
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]
    asked = docs.select(*kept)
    at = kept.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_texts(model, batch.column(at).to_pylist()))], [*kept, name])

    return asked.mapInArrow(score, T.StructType([*asked.schema.fields, T.StructField(name, T.DoubleType())]))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(model, batch.column(1).to_pylist()))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
