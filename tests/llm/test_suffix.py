import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import suffix_dedup as s


def sample_texts():
    rng = random.Random(3)
    yield b""
    yield b"a"
    yield b"banana"
    yield b"\0\0\0\0"
    yield b"ab" * 700
    yield bytes(rng.randrange(2) for _ in range(3000))
    yield bytes(rng.choice(b"abc") for _ in range(500)) * 3


@pytest.mark.parametrize("raw", list(sample_texts()))
def test_suffix_array_and_prefixes(raw):
    text = np.frombuffer(raw, np.uint8)
    sa, rank = s.suffix_array(text)
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    assert all(rank[p] == i for i, p in enumerate(sa))
    want = []
    for a, b in zip(sa, sa[1:], strict=False):
        k = 0
        while max(a, b) + k < len(raw) and raw[a + k] == raw[b + k]:
            k += 1
        want.append(k)
    assert s.common_prefixes(text, sa, rank).tolist()[1:] == want


def brute(rows):
    """doc_id, bytes, removed, spans, digest; rows in input order of equal doc_ids are interchangeable here."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            g = raw[i : i + 100]
            if g in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


def run(spark, monkeypatch, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in s.op7_suffix_dedup(spark, str(tmp_path)).collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("shard, hot", [(s.SHARD, s.HOT), (2500, 14), (2500, 3)])
def test_against_brute_force(spark, texts, frame_of, monkeypatch, tmp_path, shard, hot):
    """The columns of the input clash with names used inside; the last case salts anchors and merges their shards."""
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range(900))
    # one anchor with many different contexts
    rows = [*texts, *((1000 + i, f"{rng.random()}" * 4 + long[400:] + str(rng.random()) * 3) for i in range(12)), (2000, long), (2001, long[:450] * 2), (2002, "é" * 150), (2003, "xé" * 150 + "é" * 120)]
    monkeypatch.setattr(s, "SHARD", shard)
    monkeypatch.setattr(s, "HOT", hot)
    got = run(spark, monkeypatch, tmp_path, frame_of(rows, uid=1, hash=2, key=3, first=4))
    assert got == sorted(brute(rows), key=lambda r: (r[0] is None, r))


def test_a_hot_passage_over_many_shards(spark, frame_of, monkeypatch, tmp_path):
    """A third of all rows holds one passage, always between other words; its contexts are many, and none may be missed."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage = words(30)
    rows = [(i, f"{words(12)} {passage} {words(12)}" if i % 3 == 0 else words(40)) for i in range(240)]
    monkeypatch.setattr(s, "SHARD", 1760)
    monkeypatch.setattr(s, "HOT", 10)
    assert run(spark, monkeypatch, tmp_path, frame_of(rows)) == sorted(brute(rows))


def test_met_runs_and_hot_hashes(monkeypatch):
    """Batches of any size give the same; a hash is hot by its runs, not its rows."""
    monkeypatch.setattr(s, "HOT", 4)
    rows = [(1, 0, 5, 7, 0), (2, 0, 5, 8, 0), (3, 1, 2, 8, 0), (0, 0, 2, 9, 2), (4, 0, 1, 9, 0), *((k, 0, 1, 10, 0) for k in range(5, 10)), (0, 0, 9, 11, 2)]
    for size in (1, 2, 3, 20):
        got = [r for k in range(0, len(rows), size) for r in [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + size], strict=True)], ["uid", "first", "last", "hash", "kind"])]]
        out = [tuple(r.values()) for b in s._met(iter(got)) for r in b.to_pylist()]
        assert sorted(r for r in out if r[0] is not None) == [(k, *x, 0) for k, x in ((2, (0, 5, 8)), (3, (1, 2, 8)), (4, (0, 1, 9)), *((k, (0, 1, 10)) for k in range(5, 10)))]
        assert sorted(r[3:] for r in out if r[0] is None) == [(10, 2), (11, 3)]


def test_contexts_of_a_task_are_sent_once(monkeypatch):
    """However few contexts a task remembers, a row goes without bytes only if an earlier one has gone with them."""
    texts = ["x" * 30 + "y" * 130] * 4 + ["z" * 160]
    batch = pa.RecordBatch.from_pylist([{"doc": d, "uid": u, "text": t, "runs": [{"first": 0, "last": 60, "hash": 5, "salts": 0}]} for u, (d, t) in enumerate(zip((3, 2, 9, 1, 0), texts, strict=True))])
    for most in (1, 100):
        monkeypatch.setattr(s, "REMEMBER", most)
        out = [r for half in (batch[:2], batch[2:]) for b in s._contexts(iter([half])) for r in b.to_pylist()]
        assert len(out) == 5 and {r["uid"] for r in out if r["bytes"] is None} <= {0, 2}
    merged = pa.RecordBatch.from_pylist([{"uid": k, "first": 0, "last": 0, "doc": k, "string": c * 100} for k, c in enumerate((b"a", b"b", b"b", b"b", b"c"))])
    for cut in (1, 2, 3, 5):
        assert [u for b in s._merge(iter([merged[:cut], merged[cut:]])) for u in b.column(0).to_pylist()] == [2, 3]


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(7)
    raw = bytes(rng.choice(b"abcdef") for _ in range(5000))
    whole = s._runs([(1, 0, raw)])
    monkeypatch.setattr(s, "CHUNK", 700)
    starts = {}
    for uid, off, piece in s._pieces(1, raw):
        b = s._runs([(uid, off, piece)])
        for f, l, h, k in zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)), strict=True):
            if k != 2:
                starts |= {i: h for i in range(f, l + 1)}
    want = {i: h for f, l, h, k in zip(*(whole.column(c).to_pylist() for c in (1, 2, 3, 4)), strict=True) if k != 2 for i in range(f, l + 1)}
    assert starts == want and len(want) == len(raw) - 99


def test_empty_and_characters(spark, monkeypatch, tmp_path, frame_of):
    assert run(spark, monkeypatch, tmp_path, frame_of([])) == []
    raw = "aéb".encode()
    assert s.to_characters(raw, [(0, 2)]) == [(0, 1)] and s.to_characters(raw, [(2, 4)]) == [(3, 4)] and s.to_characters(raw, [(2, 3)]) == []
