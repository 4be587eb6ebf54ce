"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. ``cut``: documents are read in chunks of a few MB.  Each is cut into pre-tokens, the
   matches of the pattern (found piece by piece, see ``units``, and once for each
   distinct piece of a chunk); a chunk keeps its distinct words, and each document
   becomes the positions of its words in that list.  This is the local pre-aggregation:
   a word crosses the network once per chunk, packed with the others of its bucket.
2. ``encode``: the words meet by bucket of their hash, and every distinct word of
   a bucket is encoded once by the rank table.
3. ``reassemble``: the ids come back to the chunk, are lined up with the positions,
   and give the ids of each document.  Decoding joins ids with the table of token
   bytes, which is as large as the vocabulary and part of every task.

Pieces with characters that versions of Unicode class differently are words whole,
and the library splits them when it encodes them.

Blobs are compressed before they are written or shuffled, and the chunks are a table
bucketed by chunk, so that only ids move in the last step.  A worker holds one chunk, or
the distinct words of one bucket; buckets are as many as the input asks for.

Edge cases: null and empty texts have no ids; texts of any length are one chunk of
their own at most; repeated rows and null or repeated doc_ids give a row each; an
empty table gives an empty table; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import splitter, units
from tidemark.shared import bound_batches, materialize_by, tasks_for

CHUNK_CHARS = 4_000_000
_CHUNK = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("tags", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("places", pa.binary()), ("owners", pa.binary())])
CHUNK_DDL = "chunk long, bucket int, words binary, doc_ids array<long>, tags array<long>, counts array<int>, places binary, owners binary"
_IDS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary())])
IDS_DDL = "chunk long, bucket int, ids binary, lengths binary"
_OUT = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("tokens", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("decoded", pa.binary())])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned numbers below 2**32, each byte of significance by itself, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def expand(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack(words: list[bytes]) -> bytes:
    lengths = squeeze(np.fromiter(map(len, words), np.uint32, len(words)))
    return np.uint32(len(lengths)).tobytes() + lengths + zstandard.ZstdCompressor(3).compress(b"".join(words))


def unpack(blob: bytes) -> list[bytes]:
    n = 4 + int(np.frombuffer(blob, np.uint32, 1)[0])
    text = zstandard.ZstdDecompressor().decompress(blob[n:])
    ends = np.cumsum(expand(blob[4:n])).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def cut_chunk(chunk: int, rows: list[tuple], buckets: int, split) -> list[dict]:
    """The rows of one chunk of (doc_id, tag, text): its documents as places of words (and each word's bucket), and its words by bucket.

    ``split`` gives the matches of the pattern in a piece.  Words are numbered as they are met, so frequent ones have small numbers.
    """
    pieces: dict = {}
    places = []
    for _, _, text in rows:
        found = units(text or "")
        places.append(np.fromiter((pieces.setdefault(u, len(pieces)) for u in found), np.int64, len(found)))
    words: dict[str, int] = {}
    of_piece: list[int] = []
    sizes = np.empty(len(pieces), np.int64)
    for k, unit in enumerate(pieces):
        matches = split(unit)
        of_piece += [words.setdefault(w, len(words)) for w in matches]
        sizes[k] = len(matches)
    # every place of a piece becomes the places of its words
    flat = np.concatenate(places) if places else np.zeros(0, np.int64)
    size = sizes[flat]
    ends = np.cumsum(size)
    begins = (np.cumsum(sizes) - sizes)[flat]
    index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - (ends - size), size)
    edges = np.cumsum([0, *map(len, places)])
    counts = np.diff(np.append(0, ends)[edges]).astype(np.int32)
    raw = [w.encode() for w in words]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int32, len(raw))
    order = np.argsort(bucket, kind="stable")
    doc_ids, tags, _ = zip(*rows, strict=True)
    out = [{"chunk": chunk, "doc_ids": doc_ids, "tags": tags, "counts": counts, "places": squeeze(np.array(of_piece, np.uint32)[index]), "owners": squeeze(bucket)}]
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        out.append({"chunk": chunk, "bucket": int(bucket[part[0]]), "words": pack([raw[i] for i in part])})
    return [dict.fromkeys(_CHUNK.names) | row for row in out]


def cutter(buckets: int, pattern: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern)
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2] or "")
                if size >= CHUNK_CHARS:
                    yield pa.RecordBatch.from_pylist(cut_chunk(part << 32 | k, held, buckets, split), _CHUNK)
                    k, held, size = k + 1, [], 0
        if held:
            yield pa.RecordBatch.from_pylist(cut_chunk(part << 32 | k, held, buckets, split), _CHUNK)

    return cut


def word_encoder(ranks_path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by bucket; what is known of one bucket is forgotten with it."""
        import tiktoken

        encoder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        at, known = None, {}
        for batch in batches:
            out = []
            for chunk, bucket, blob in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if bucket != at:
                    at, known = bucket, {}
                words = unpack(blob)
                for w in words:
                    if w not in known:
                        known[w] = np.array(encoder.encode_ordinary(w.decode()), "<u4").tobytes()
                ids = [known[w] for w in words]
                lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), "<u4")
                out.append({"chunk": chunk, "bucket": bucket, "ids": squeeze(flat), "lengths": squeeze(lengths)})
            yield pa.RecordBatch.from_pylist(out, _IDS)

    return encode


def assembler(ranks_path: str, columns: list[str]):
    schema = pa.schema([_OUT.field(c) for c in columns])
    table: list[list[bytes]] = []

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        if not table:
            ranks = read_ranks(ranks_path)
            token_bytes = [b""] * (max(ranks.values()) + 1)
            for token, i in ranks.items():
                token_bytes[i] = token
            table.append(token_bytes)
        token_bytes = table[0]
        parts = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        none = [np.zeros(0, "<u4")]
        lengths = np.concatenate([expand(p["lengths"]) for p in parts] or none).astype(np.int64)
        flat = np.concatenate([expand(p["ids"]) for p in parts] or none)
        ends = np.cumsum(lengths).tolist()
        ids = flat.tolist()
        raw = flat.tobytes()
        spans = list(zip([0, *ends], ends, strict=False))
        decimal = [" ".join(map(str, ids[a:b])).encode() for a, b in spans]
        decoded = [b"".join([token_bytes[i] for i in ids[a:b]]) for a, b in spans]
        binary = [raw[4 * a : 4 * b] for a, b in spans]
        out: dict[str, list] = {c: [] for c in columns}
        for row in left.to_pylist():
            order = np.argsort(expand(row["owners"]), kind="stable")
            place_of = np.empty(len(order), np.int64)
            place_of[order] = np.arange(len(order))  # ids come bucket by bucket
            places, at = place_of[expand(row["places"])], 0
            for doc_id, tag, n in zip(row["doc_ids"], row["tags"], row["counts"], strict=True):
                where = places[at : at + n]
                own = where.tolist()
                at += n
                out["doc_id"].append(doc_id)
                if "place" in out:
                    out["place"].append(tag)
                out["n_tokens"].append(int(lengths[where].sum()))
                if "ids" in out or "tokens" in out:
                    whole = b"".join([binary[i] for i in own])
                    if "ids" in out:
                        out["ids"].append(whole)
                    if "tokens" in out:
                        out["tokens"].append(np.frombuffer(whole, "<i4"))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(sha256(b" ".join([decimal[i] for i in own])).hexdigest())
                if "decoded_sha256" in out or "decoded" in out:
                    back = b"".join([decoded[i] for i in own])
                    if "decoded" in out:
                        out["decoded"].append(back)
                    if "decoded_sha256" in out:
                        out["decoded_sha256"].append(sha256(back).hexdigest())
        return pa.table(out, schema=schema)

    return assemble


def _met(docs: DataFrame, ranks_path: str, pattern: str, buckets: int | None, place: Column | None):
    """Chunks of documents and the ids of their words, grouped by chunk."""
    bound_batches(docs.sparkSession)
    buckets = buckets or tasks_for(docs)
    slim = docs.select(F.col("doc_id").cast("long"), (F.lit(None) if place is None else place).cast("long").alias("tag"), F.col("text").cast("string"))
    chunks = materialize_by(slim.mapInArrow(cutter(buckets, pattern), CHUNK_DDL), "bpe-chunks", "chunk", buckets)
    words = chunks.where("bucket is not null").select("chunk", "bucket", "words").repartition("bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(word_encoder(ranks_path, pattern), IDS_DDL)
    held = chunks.where("bucket is null").select("chunk", "doc_ids", "tags", "counts", "places", "owners")
    return held.groupBy("chunk").cogroup(ids.groupBy("chunk"))


_KINDS = {"doc_id": "long", "place": "long", "n_tokens": "long", "ids": "binary", "tokens": "array<int>", "ids_sha256": "string", "decoded_sha256": "string", "decoded": "binary"}


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"{c} {_KINDS[c]}" for c in columns)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, columns=("doc_id", "n_tokens", "ids"), buckets: int | None = None, place: Column | None = None) -> DataFrame:
    """One row per document with the asked columns: doc_id, n_tokens, ids (little-endian unsigned 32-bit), tokens (the same as a list), decoded, ids_sha256, decoded_sha256, and place, the long that is given for it."""
    columns = list(dict.fromkeys(["doc_id", "n_tokens", *columns]))
    return _met(docs, ranks_path, pattern, buckets, place).applyInArrow(assembler(ranks_path, columns), _ddl(columns))


_ORDERED = ["doc_id", "place", "n_tokens", "tokens", "ids_sha256", "decoded_sha256"]
_RUN = pa.schema([("task", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ids", pa.binary()), ("digests", pa.binary())])


def runs_of(rows: pa.Table, tasks: int, total: int) -> pa.Table:
    """Rows of consecutive places that go to one task, as one row with their ids compressed."""
    place = rows.column("place").to_numpy()
    task = place * tasks // total
    edges = np.flatnonzero((np.diff(place) != 1) | (np.diff(task) != 0)) + 1
    doc_ids, counts = rows.column("doc_id").to_pylist(), rows.column("n_tokens").to_pylist()
    tokens = rows.column("tokens").combine_chunks()
    flat, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
    digests = [bytes.fromhex(x + y) for x, y in zip(rows.column("ids_sha256").to_pylist(), rows.column("decoded_sha256").to_pylist(), strict=True)]
    out = []
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(place)], strict=True):
        if a < b:
            out.append({"task": int(task[a]), "first": int(place[a]), "doc_ids": doc_ids[a:b], "counts": counts[a:b], "ids": squeeze(flat[offsets[a] : offsets[b]]), "digests": b"".join(digests[a:b])})
    return pa.Table.from_pylist(out, _RUN)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([_OUT.field(c) for c in _ORDERED])
    for batch in batches:
        for run in batch.to_pylist():
            ends = np.cumsum([0, *run["counts"]])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(expand(run["ids"]).astype(np.int32)))
            digests = [run["digests"][k : k + 32].hex() for k in range(0, len(run["digests"]), 32)]
            places = pa.array(np.arange(run["first"], run["first"] + len(run["counts"])))
            yield pa.RecordBatch.from_arrays([pa.array(run["doc_ids"], pa.int64()), places, pa.array(run["counts"], pa.int64()), tokens, pa.array(digests[::2]), pa.array(digests[1::2])], schema=schema)


def encode_in_order(docs: DataFrame, ranks_path: str, pattern: str, place: Column, total: int) -> DataFrame:
    """doc_id, place, n_tokens, tokens and both digests of every document, sorted by ``place``: numbers from 0 to below ``total``.

    Ids are compressed on the way, a run of consecutive places at a time, as sorting lists of tokens would move more than the texts.
    """
    tasks, assemble = tasks_for(docs), assembler(ranks_path, _ORDERED)

    def packed(left: pa.Table, right: pa.Table) -> pa.Table:
        return runs_of(assemble(left, right), tasks, total)

    runs = _met(docs, ranks_path, pattern, None, place).applyInArrow(packed, "task int, first long, doc_ids array<long>, counts array<long>, ids binary, digests binary")
    return runs.repartitionById(tasks, F.col("task")).sortWithinPartitions("first").mapInArrow(_unpack, _ddl(_ORDERED))


def op8_byte_bpe(spark, sf_dir: str, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
