import functools
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import token_records, word_bpe
from tidemark.llm.units import USUAL, splitter, unit_text, units
from tidemark.shared import new_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rank_encoder():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_bpe.read_ranks(RANKS), special_tokens={})


@given(st.text(alphabet=st.sampled_from(list("ab'st,.-1 \n")), max_size=20))
@settings(max_examples=400, deadline=None)
def test_pieces_are_split_as_the_pattern_does(text):
    assert public_tokenizers.PATTERN == USUAL
    split = splitter(USUAL)
    assert [w for u in units(text) for w in split(u)] == regex.findall(USUAL, text)


@given(st.text(alphabet=st.sampled_from(list("ab'st \n\t\x1c  é1!\r世")), max_size=30))
@settings(max_examples=400, deadline=None)
def test_units_are_encoded_alone_as_in_the_whole(rank_encoder, text):
    parts = [unit_text(u) for u in units(text)]
    assert "".join(parts) == text
    assert [i for p in parts for i in rank_encoder.encode_ordinary(p)] == rank_encoder.encode_ordinary(text)


def test_encode_and_decode_equal_the_library(spark, texts, frame_of, rank_encoder):
    got = word_bpe.encode_documents(frame_of(texts, chunk=1, bucket=2, place=3, tag=4), RANKS, public_tokenizers.PATTERN, ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"], buckets=3).collect()
    want = []
    for doc_id, text in texts:
        ids = rank_encoder.encode_ordinary(text or "")
        back = (text or "").encode()
        want.append((doc_id, len(ids), np.array(ids, "<u4").tobytes(), sha256(" ".join(map(str, ids)).encode()).hexdigest(), back, sha256(back).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, bytes(r.decoded), r.decoded_sha256) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("chars, buckets", [(1, 1), (60, 4), (5000, 2)])
def test_chunks_of_any_size_give_the_same(spark, texts, rank_encoder, chars, buckets, monkeypatch):
    """Every step of the operator by hand, with several chunks in a task."""
    split, rows = splitter(public_tokenizers.PATTERN), []
    held, chunks = [], []
    for k, (doc_id, text) in enumerate(texts):
        held.append((doc_id, k, text))
        if sum(len(t or "") for _, _, t in held) >= chars:
            chunks.append(held)
            held = []
    chunks.append(held)
    for c, held in enumerate(c for c in chunks if c):
        rows += word_bpe.cut_chunk(c, held, buckets, split)
    words = sorted((r for r in rows if r["bucket"] is not None), key=lambda r: r["bucket"])
    batches = [pa.RecordBatch.from_pylist([{n: r[n] for n in ("chunk", "bucket", "words")} for r in words[k : k + 3]]) for k in range(0, len(words), 3)]
    ids = pa.Table.from_batches(list(word_bpe.word_encoder(RANKS, public_tokenizers.PATTERN)(iter(batches))))
    assemble, got = word_bpe.assembler(RANKS, ["doc_id", "place", "n_tokens", "ids"]), []
    for r in rows:
        if r["bucket"] is None:
            left = pa.Table.from_pylist([r], word_bpe._CHUNK)
            got += assemble(left, ids.filter(pc.equal(ids.column("chunk"), r["chunk"]))).to_pylist()
    want = [rank_encoder.encode_ordinary(t or "") for _, t in texts]
    assert [(r["doc_id"], r["place"], r["ids"]) for r in got] == [(d, k, np.array(w, "<u4").tobytes()) for k, ((d, _), w) in enumerate(zip(texts, want, strict=True))]


def test_runs_of_places(spark, texts, frame_of, rank_encoder):
    """Rows in any order come back by place; a run ends where places jump and where a task ends."""
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(texts)], "doc_id long, text string, at long").repartition(3, "text")
    got = word_bpe.encode_in_order(docs, RANKS, public_tokenizers.PATTERN, F.col("at"), len(texts)).collect()
    assert [(r.place, r.doc_id, r.tokens) for r in got] == [(k, d, rank_encoder.encode_ordinary(t or "")) for k, (d, t) in enumerate(texts)]
    assert all(r.decoded_sha256 == sha256((t or "").encode()).hexdigest() and r.n_tokens == len(r.tokens) and r.ids_sha256 == sha256(" ".join(map(str, r.tokens)).encode()).hexdigest() for r, (_, t) in zip(got, texts, strict=True))
    rows = pa.table({"doc_id": [5, 6, 7, 8], "place": [2, 3, 4, 9], "n_tokens": [1, 0, 2, 1], "tokens": [[1], [], [2, 3], [4]], "ids_sha256": ["aa" * 32] * 4, "decoded_sha256": ["bb" * 32] * 4})
    assert [(r["task"], r["first"], r["counts"]) for r in word_bpe.runs_of(rows, 3, 12).to_pylist()] == [(0, 2, [1, 0]), (1, 4, [2]), (2, 9, [1])]


def test_words_are_matches_of_the_pattern():
    texts = ["don't stop, it's 12 o'clock!", "well, stop it  now\n\nor é\u4e16界x"]
    rows = word_bpe.cut_chunk(1, [(1, None, texts[0]), (2, None, texts[1])], 2, splitter(public_tokenizers.PATTERN))
    words = {w.decode() for r in rows[1:] for w in word_bpe.unpack(r["words"])}
    assert {"don", "'t", " stop", ",", " 12", "clock", "or"} <= words and not {" stop,", " 12 o"} & words
    assert rows[0]["counts"].tolist()[0] == len(regex.findall(public_tokenizers.PATTERN, texts[0]))


def test_empty_tables(spark, frame_of):
    assert word_bpe.encode_documents(frame_of([]), RANKS, public_tokenizers.PATTERN).collect() == []
    folder = new_path(spark, "t")
    assert token_records.write_records(frame_of([], h=1, n=2), JSON, folder) == []
    assert token_records.read_records(spark, folder, []).collect() == []


@pytest.mark.parametrize("size", [token_records.READ_BYTES, 100])
def test_records_hold_the_ids_in_order(spark, texts, frame_of, size):
    """Records larger than what is read at once, texts that hold an added token, and columns named like the results."""
    texts = [*texts, (901, "a <|endoftext|> b"), (902, "<|endoftext|><|endoftext|>"), (903, " x<|endoftext|>  "), (903, "other"), (903, None)]
    frame_of = functools.partial(frame_of, start=1, n_tokens=2, h=3, n=4)
    folder = new_path(spark, "t")
    manifest = token_records.write_records(frame_of(texts), JSON, folder)
    tokenizer = Tokenizer.from_file(JSON)
    want, at = [], 0
    place = lambda r: (r[0] is not None, r[0] or 0, 42 if r[1] is None else int(np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).view(np.int64)))
    for doc_id, text in sorted(texts, key=place):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in token_records.read_records(spark, folder, manifest).collect()), key=lambda r: r[1])
    assert got == want
    files, base = token_records.filesystem(folder)
    small = [zlib.crc32(ids.tobytes()) for n, _, _ in manifest for _, ids in token_records.read_frames(files, f"{base}/part-{n:06d}", size)]
    assert small == [w[3] for w in want]
    number, docs, _ = manifest[-1]
    doc_id, ids = token_records.read_record(folder, number, docs - 1)
    assert doc_id == want[-1][0] and zlib.crc32(ids.tobytes()) == want[-1][3]


def test_frames_detect_damage():
    data = bytearray(token_records.frame(7, np.array([1, 70000], "<u4")))
    assert token_records.unframe(bytes(data))[0] == 7 and token_records.unframe(bytes(data))[1].tolist() == [1, 70000]
    for at in (0, 9, 14, len(data) - 1):
        bad = data.copy()
        bad[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(bytes(bad))
