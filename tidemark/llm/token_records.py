"""Token ids as files of length-delimited binary records, with an offset index beside each.

A record file is a sequence of frames::

    length      unsigned 64-bit, little-endian: bytes of the payload
    check       unsigned 32-bit: masked CRC-32 of the eight length bytes
    payload     key kind (1 byte: 1 if doc_id is not null), width (1 byte: 2 or 4 bytes
                an id), doc_id (signed 64-bit), then the ids, little-endian
    check       unsigned 32-bit: masked CRC-32 of the payload

The mask rotates the CRC right by 15 bits and adds a constant, so that a checksum
of data that holds checksums stays useful.  The index file holds one unsigned
64-bit offset per record and the file's length at the end: a reader that
shuffles seeks to any record without reading those before it.

Documents are dealt by ranges of doc_id and sorted, so the files in the order of
their numbers hold the documents in ascending order (null first; rows of equal doc_id by
a hash of the text, so that many of them are dealt as well); files are as many as the input asks for.
A task writes under a name of its own attempt and renames at the end; a repeated
task writes the same bytes.  Files are opened by pyarrow.fs in the shared folder.

Encoding is the tokenizers library's, as it is by default: the strings of its added
tokens are those tokens wherever they occur, and such a text goes to the library whole.
Any other text is cut where the pre-tokenizer always cuts, a worker remembers the ids
of up to ``REMEMBER`` pieces, and new pieces go to the library.

Edge cases: null and empty texts are records with the end id alone; repeated rows
are records each; a text of any length is one record, and the reader takes at least one
record at a time; an empty table writes no files and gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import gc
import re
import struct
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import USUAL, plain, unit_text, units
from tidemark.shared import bound_batches, new_path, tasks_for

REMEMBER = 600_000
READ_BYTES = 8 << 20
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
KEY = struct.Struct("<BBq")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if ids.size == 0 or int(ids.max()) < 1 << 16 else 4
    payload = b"".join((KEY.pack(doc_id is not None, width, doc_id or 0), ids.astype(f"<u{width}").tobytes()))
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(data: bytes, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids (unsigned 32-bit) and the offset of the next frame; ValueError if a checksum is wrong."""
    length, check = HEAD.unpack_from(data, at)
    if masked_crc(data[at : at + 8]) != check:
        raise ValueError(f"length at {at} doesn't match its checksum")
    payload = data[at + 12 : at + 12 + length]
    if len(payload) < length or masked_crc(payload) != struct.unpack_from("<I", data, at + 12 + length)[0]:
        raise ValueError(f"record at {at} doesn't match its checksum")
    known, width, doc_id = KEY.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", -1, KEY.size).astype("<u4"), at + length + 16


def byte_letters() -> dict[int, str]:
    """The letters that a byte-level vocabulary writes bytes with: printable ones stand for themselves, others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


@functools.cache
def encoder(tokenizer_path: str):
    """A function from texts to the ids of each, as bytes of little-endian unsigned 32-bit integers.

    A piece that is not remembered is split as the tokenizer's own pattern does, and each
    match goes to the library's BPE model, which saves the rest of its machinery for every
    short text; pieces with uncommon characters go through all of the library.  A worker
    keeps the function, and what it remembers, from task to task.
    """
    import regex
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(tokenizer_path)
    added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    holds_added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
    kind = repr(tokenizer.pre_tokenizer)
    direct = isinstance(tokenizer.pre_tokenizer, ByteLevel) and tokenizer.normalizer is None and "use_regex=True" in kind and "add_prefix_space=False" in kind
    split = regex.compile(USUAL).findall
    letters, tokenize = byte_letters(), tokenizer.model.tokenize
    pack = [struct.pack("<I", i) for i in range(tokenizer.get_vocab_size())]
    gap = letters[32]

    def word_ids(word: str) -> bytes:
        if word.isascii() and word.isprintable() and " " not in word[1:]:
            written = gap + word[1:] if word[0] == " " else word
        else:
            written = word.encode().decode("latin-1").translate(letters)
        return b"".join([pack[t.id] for t in tokenize(written)])

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    class Known(dict):
        """Ids by unit.  The first to be met are mostly the frequent ones, so a full table keeps its older half."""

        def __missing__(self, unit) -> bytes:
            text = unit_text(unit)
            if not plain(text):
                ids = whole(text)
            elif isinstance(unit, str) and (core := unit.rstrip(punctuation)).isalpha():
                # a word and what follows it: two matches
                ids = self[core] + self[(unit[len(core) :],)] if len(core) < len(unit) else word_ids(text)
            else:
                found = split(text)
                ids = word_ids(found[0]) if len(found) == 1 else b"".join([self[(w,)] for w in found])
            if len(self) > REMEMBER:
                for key in list(self)[REMEMBER // 2 :]:
                    del self[key]
            self[unit] = ids
            return ids

    known = Known()
    gc.set_threshold(100_000, 50, 50)  # the table holds nothing that could be a cycle, and is walked in vain

    def encode(texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            if not text:
                yield b""
            elif not direct or holds_added(text):
                yield whole(text)
            else:
                yield b"".join([known[u] for u in units(text)])

    return encode


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def writer(tokenizer_path: str, folder: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = filesystem(folder)
        number, own = context.partitionId(), f".{context.taskAttemptId()}.tmp"
        name = f"{base}/part-{number:06d}"
        encode, end = encoder(tokenizer_path), struct.pack("<I", end_id)
        offsets, at, tokens, out = [], 0, 0, None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(ids), 256):
                frames = []
                for doc_id, found in zip(ids[k : k + 256], encode(texts[k : k + 256]), strict=True):
                    frames.append(frame(doc_id, np.frombuffer(found + end, "<u4")))
                    offsets.append(at)
                    at += len(frames[-1])
                    tokens += len(found) // 4 + 1
                out = out or files.open_output_stream(f"{name}.rec{own}")
                out.write(b"".join(frames))
        if out is None:
            return
        out.close()
        with files.open_output_stream(f"{name}.idx{own}") as index:
            index.write(np.array([*offsets, at], "<u8").tobytes())
        for kind in ("rec", "idx"):
            files.move(f"{name}.{kind}{own}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pylist([{"number": number, "docs": len(offsets), "tokens": tokens}])

    return write


def write_records(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0) -> list[tuple[int, int, int]]:
    """Write all documents to ``folder``; (file number, documents, tokens) of each file in order, which come to the driver."""
    spark = docs.sparkSession
    bound_batches(spark, megabytes=4)
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.monotonically_increasing_id().alias("n"))
    dealt = slim.repartitionByRange(tasks_for(docs), "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n").select("doc_id", "text")
    return sorted(tuple(r) for r in dealt.mapInArrow(writer(tokenizer_path, folder, end_id), "number long, docs long, tokens long").collect())


def read_frames(files, name: str, size: int = READ_BYTES) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a file in order, by its index, about ``size`` bytes at a time, and one record at least."""
    with files.open_input_stream(f"{name}.idx") as f:
        offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
    first = 0
    with files.open_input_file(f"{name}.rec") as f:
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
            f.seek(int(offsets[first]))
            data = f.read(int(offsets[last] - offsets[first]))
            for k in range(first, last):
                doc_id, ids, end = unframe(data, int(offsets[k] - offsets[first]))
                if end != offsets[k + 1] - offsets[first]:
                    raise ValueError(f"record {k} of {name} doesn't end where the index says")
                yield doc_id, ids
            first = last


def read_record(folder: str, number: int, k: int) -> tuple[int | None, np.ndarray]:
    """Record ``k`` of file ``number``, by two seeks: what a shuffling reader does."""
    files, base = filesystem(folder)
    name = f"{base}/part-{number:06d}"
    with files.open_input_file(f"{name}.idx") as f:
        f.seek(8 * k)
        a, b = np.frombuffer(f.read(16), "<u8").tolist()
    with files.open_input_file(f"{name}.rec") as f:
        f.seek(a)
        return unframe(f.read(b - a))[:2]


def reader(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at, out = row["start"], []
                for doc_id, ids in read_frames(files, f"{base}/part-{row['number']:06d}"):
                    out.append({"doc_id": doc_id, "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())})
                    at += len(ids)
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
                yield pa.RecordBatch.from_pylist(out, schema)

    return read


def read_records(spark, folder: str, manifest: list[tuple[int, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, a task per file."""
    starts, at = [], 0
    for number, _, tokens in manifest:
        starts.append((number, at))
        at += tokens
    files = spark.createDataFrame(starts, "number long, start long").repartition(max(1, len(starts)))
    return files.mapInArrow(reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_records(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Where each document's ids stand in the written files, read back."""
    import public_tokenizers

    folder = new_path(spark, "token-records")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_records(docs, tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_records(spark, folder, manifest)
