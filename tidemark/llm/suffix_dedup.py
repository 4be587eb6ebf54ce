"""Removal of repeated byte strings, decided by suffix arrays.

A byte goes if it is covered by a string of ``span`` = 100 bytes that also starts
earlier (in a document of smaller doc_id, or further left in the same one).
Strings never cross documents, and all are judged on the input.

1. ``anchors``: the start of every 100-byte string is assigned to the 24 bytes in it
   whose hash is least (rightmost of equal ones).  That choice depends on the string alone,
   so equal strings have equal anchors, and neighbouring starts share theirs: a document
   becomes runs of starts (first, last, hash of the anchor), about one for 39 bytes.
2. ``shared``: only runs whose anchor occurs elsewhere can hold repeats.  A task
   counts what repeats inside its own chunk and sends one row for each such
   hash, so a frequent hash costs a row per chunk; the rest meets by hash.  A hash
   with more runs than ``HOT`` gets as many salts as it needs to fit shards.
3. ``contexts``: the bytes of the strings of a shared run go to the shard of its hash (and
   salt).  Of runs with equal bytes a task sends the earliest it knows; the others are
   repeats already and go without bytes, each to a shard of its own.
4. ``shards``: of equal contexts again only the earliest counts.  The suffix array of up to
   ``SHARD`` bytes of distinct ones (Larsson-Sadakane refinement), common prefixes
   (Kasai), and in each group of strings that agree in 100 bytes all but the earliest are
   repeats.
5. ``merge``: a hot anchor lies in several shards.  The strings that were the earliest of
   their shard are sorted across shards, and each is looked up by binary search: the
   first of equal ones is the earliest of all.
6. The repeated starts return to their documents, which drop what they cover.

No task holds more than a shard, or than the strings of one batch, whatever the
frequency of an anchor.  Documents and shared runs are written to tables bucketed by
row, so that joining runs and repeats to documents does not shuffle text again.

Edge cases: null text counts as empty; texts under 100 bytes lose nothing; rows of
equal doc_id (and null ones, which come last) are ordered by their row number, so
of repeated rows all but one go; texts longer than a chunk are cut into
overlapping pieces; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import bound_batches, materialize, materialize_by, remove, tasks_for

SPAN, GRAM = 100, 24
WINDOW = SPAN - GRAM + 1
CHUNK = 3 << 20
SHARD = 1_600_000
HOT = SHARD // (SPAN + WINDOW - 1)  # so many contexts of an anchor fit a shard
REMEMBER = 100_000  # contexts that a task compares new ones with
_POSITION = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


# --- suffix arrays -------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of up to 2**21 - 2 bytes, by Larsson-Sadakane refinement.

    Suffixes are sorted by four symbols, then groups of equal ones are sorted by the rank of
    the suffix 4, 8, 16, ... further on; a group of one is done and not touched again.
    Keys and indices share one 64-bit word, so that a plain sort of words sorts the suffixes.
    """
    n = len(text)
    if n > (1 << 21) - 2:
        raise ValueError("a shard holds up to 2**21 - 2 bytes")
    symbols = np.zeros(n + 3, np.uint64)
    symbols[:n] = text
    symbols[:n] += np.uint64(1)
    key = symbols[:n].copy()
    for k in (1, 2, 3):
        key = key << np.uint64(9) | symbols[k : n + k]
    low = np.uint64((1 << 21) - 1)
    packed = np.sort(key << np.uint64(21) | np.arange(n, dtype=np.uint64))
    sa = (packed & low).astype(np.int64)
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1

    def settle(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Give the suffixes in these slots their new ranks; returns the slots of groups of two or more."""
        first = np.ones(len(slots), bool)
        first[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(first)
        rank[sa[slots]] = np.repeat(slots[starts], np.diff(np.append(starts, len(slots))))
        alone = first.copy()
        alone[:-1] &= first[1:]
        return slots[~alone]

    slots = settle(np.arange(n), packed >> np.uint64(21))
    step = 4
    while len(slots):
        at = sa[slots]
        after = rank[np.minimum(at + step, n)] + 1
        packed = np.sort(rank[at].astype(np.uint64) << np.uint64(42) | after.astype(np.uint64) << np.uint64(21) | np.arange(len(slots), dtype=np.uint64))
        sa[slots] = at[(packed & low).astype(np.int64)]
        slots = settle(slots, packed >> np.uint64(21))
        step *= 2
    return sa, rank[:n]


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Kasai: length of the common prefix of each suffix in the array with the one before it.

    In text order that length falls by one at most from one position to the next, and by exactly one
    unless the preceding bytes differ.  So only positions of the latter kind are compared.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    held = np.ones(n, bool)
    if n > 1:
        inner = before[1:]
        held[1:] = (inner <= 0) | (text[:-1] != text[inner - 1])
    words = np.zeros(n + 8, np.uint64)
    padded = np.zeros(n + 16, np.uint64)
    padded[:n] = text
    for k in range(8):
        words |= padded[k : n + 8 + k] << np.uint64(56 - 8 * k)
    prefix = np.zeros(n, np.int64)
    at = np.flatnonzero(held & (before >= 0))
    with_ = before[at]
    room = n - np.maximum(at, with_)
    length = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    while len(todo):
        off = length[todo]
        differ = words[np.minimum(at[todo] + off, n)] ^ words[np.minimum(with_[todo] + off, n)]
        same = _equal_bytes(differ)
        length[todo] = off + same
        todo = todo[(same == 8) & (length[todo] < room[todo])]
    prefix[at] = np.minimum(length, room)
    index = np.arange(n)
    origin = np.maximum.accumulate(np.where(held, index, 0))
    prefix = np.maximum(prefix[origin] - (index - origin), 0)
    out = np.empty(n, np.int64)
    out[rank] = prefix
    out[0] = 0
    return out


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Leading zero bytes of each word."""
    same = np.zeros(len(differ), np.int64)
    left = differ.copy()
    for bits in (32, 16, 8):
        zero = left >> np.uint64(64 - bits) == 0
        same += zero * (bits // 8)
        left = np.where(zero, left << np.uint64(bits), left)
    return same + (left >> np.uint64(56) == 0)


# --- anchors --------------------------------------------------------------------------------


def anchor_runs(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start and anchor hash of each run, in a concatenation of pieces that end at ``ends``."""
    n = len(text)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none
    power = lambda e: np.uint64(pow(_BASE, e, 1 << 64))
    grams = {1: text.astype(np.uint64) + np.uint64(1)}
    for k in (1, 2, 4, 8):
        grams[2 * k] = grams[k][:-k] * power(k) + grams[k][k:]
    count = n - GRAM + 1
    hashes = grams[16][:count] * power(8) + grams[8][16 : 16 + count]
    del grams
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    least = (hashes & ~_POSITION) | (_POSITION - np.arange(count, dtype=np.uint64))
    size = 1
    while size * 2 <= WINDOW:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    starts = n - SPAN + 1
    least = np.minimum(least[:starts], least[WINDOW - size : WINDOW - size + starts])
    anchor = (_POSITION - (least & _POSITION)).astype(np.int64)
    valid = np.ones(starts, bool)
    for end in ends[:-1]:
        valid[max(0, end - SPAN + 1) : end] = False
    at = np.flatnonzero(valid)
    own = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], hashes[own[first]].view(np.int64)


def _pieces(uid: int, raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    for k in range(0, max(1, len(raw) - SPAN + 1), CHUNK):
        yield uid, k, raw[k : k + CHUNK + SPAN - 1]


_RUNS = pa.schema([("uid", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("hash", pa.int64()), ("kind", pa.int8())])


def _runs(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """Runs of a chunk.  kind 0: alone in it; 1: shared within it; 2: a probe that other chunks' runs may meet, with their number as ``last``."""
    lengths = np.fromiter((len(raw) for _, _, raw in held), np.int64, len(held))
    ends = np.cumsum(lengths)
    first, last, hashes = anchor_runs(np.frombuffer(b"".join(raw for _, _, raw in held), np.uint8), ends)
    piece = np.searchsorted(ends, first, "right")
    shift = np.array([off for _, off, _ in held], np.int64) - (ends - lengths)
    uid = np.array([u for u, _, _ in held], np.int64)[piece]
    distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    probes = distinct[counts > 1]
    kind = (counts[inverse] > 1).astype(np.int8)
    empty = np.zeros(len(probes), np.int64)
    columns = [np.concatenate(x) for x in ((uid, empty), (first + shift[piece], empty), (last + shift[piece], counts[counts > 1]), (hashes, probes), (kind, np.full(len(probes), 2, np.int8)))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_RUNS)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for piece in _pieces(uid, (text or "").encode()):
                if len(piece[2]) >= SPAN:
                    held.append(piece)
                    size += len(piece[2])
                if size >= CHUNK:
                    yield _runs(held)
                    held, size = [], 0
    if held:
        yield _runs(held)


_MET = pa.schema([*list(_RUNS)[:4], ("salts", pa.int32())])


def _hot(hashes: np.ndarray, runs: np.ndarray) -> pa.RecordBatch:
    """A row without uid for each hash of more than ``HOT`` runs."""
    many = runs > HOT
    n = int(many.sum())
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([none, none, none, pa.array(hashes[many]), pa.array(-(-runs[many] // HOT), pa.int32())], schema=_MET)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash, the runs whose hash another row has too, and the hot hashes with their salts."""
    of, rows, runs, alone = None, 0, 0, None  # the last hash, its rows and runs so far, and its row while that is the only one
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        _, _, last, hashes, kind = columns
        if not len(hashes):
            continue
        edge = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        size = np.diff(np.append(edge, len(hashes)))
        all_rows, all_runs = size.copy(), np.add.reduceat(np.where(kind == 2, last, 1), edge)
        if of == hashes[0]:
            all_rows[0], all_runs[0] = all_rows[0] + rows, all_runs[0] + runs
            if alone is not None:
                yield alone
        elif of is not None:
            yield _hot(np.array([of]), np.array([runs]))
        chosen = (kind == 0) & np.repeat(all_rows > 1, size)
        zero = pa.array(np.zeros(int(chosen.sum()), np.int32))
        yield pa.RecordBatch.from_arrays([*(pa.array(c[chosen]) for c in columns[:4]), zero], schema=_MET)
        yield _hot(hashes[edge[:-1]], all_runs[:-1])
        of, rows, runs = int(hashes[-1]), int(all_rows[-1]), int(all_runs[-1])
        single = rows == 1 and kind[-1] == 0
        alone = pa.RecordBatch.from_arrays([*(pa.array(c[-1:]) for c in columns[:4]), pa.array([0], pa.int32())], schema=_MET) if single else None
    if of is not None:
        yield _hot(np.array([of]), np.array([runs]))


# --- contexts and shards ---------------------------------------------------------------------

_CONTEXT = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("uid", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("hot", pa.bool_()), ("bytes", pa.binary())])
CONTEXT_DDL = "key long, doc long, uid long, first long, last long, hot boolean, bytes binary"
_REPEATS = pa.schema([("uid", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("doc", pa.int64()), ("string", pa.binary())])
REPEATS_DDL = "uid long, first long, last long, doc long, string binary"


def _salted(h: int, salt: int) -> int:
    mixed = (h ^ (salt + 1) * _BASE) & (1 << 64) - 1
    return mixed - (1 << 64) if mixed >> 63 else mixed


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run with its bytes; without them for a run whose bytes a row sent before has, further ahead in the order."""
    sent: dict[bytes, tuple[int, int, int]] = {}
    for batch in batches:
        docs, uids, texts = (batch.column(k).to_pylist() for k in range(3))
        runs = batch.column(3)
        offsets = runs.offsets.to_numpy()
        flat = runs.values
        firsts, lasts, hashes, salts = (flat.field(k).to_pylist() for k in range(4))
        out: list[tuple] = []
        for d in sorted(range(len(docs)), key=lambda d: (docs[d], uids[d])):
            raw, a, b = (texts[d] or "").encode(), offsets[d], offsets[d + 1]
            doc, uid = docs[d], uids[d]
            for first, last, h, n in sorted(zip(firsts[a:b], lasts[a:b], hashes[a:b], salts[a:b], strict=True)):
                own, place = raw[first : last + SPAN], (doc, uid, first)
                known = sent.get(own)
                if known is not None and known < place:
                    out.append((uid ^ first << 20, doc, uid, first, last, False, None))
                    continue
                if len(sent) >= REMEMBER:
                    sent.clear()
                sent[own] = place
                out.append((_salted(h, (uid + first) % n) if n else h, doc, uid, first, last, n > 0, own))
            if len(out) > 20_000:
                yield _context_batch(out)
                out = []
        yield _context_batch(out)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_CONTEXT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CONTEXT, strict=True)], schema=_CONTEXT)


def _ranks(table: pa.Table) -> np.ndarray:
    """The rank of each row by document and place."""
    doc, uid, first = (table.column(k).to_numpy() for k in (1, 2, 3))
    rank = np.empty(len(doc), np.int64)
    rank[np.lexsort((first, uid, doc))] = np.arange(len(doc))
    return rank


def _ranges(table: pa.Table) -> pa.RecordBatch:
    """All starts of these contexts as repeats."""
    uid, first, last = (table.column(k).combine_chunks() for k in (2, 3, 4))
    return pa.RecordBatch.from_arrays([uid, first, last, pa.nulls(len(uid), pa.int64()), pa.nulls(len(uid), pa.binary())], schema=_REPEATS)


def distinct_contexts(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The earliest of equal contexts, and all others."""
    same = pa.chunked_array([table.column("bytes").combine_chunks()]).combine_chunks().dictionary_encode().indices.to_numpy()
    rank = _ranks(table)
    least = np.full(int(same.max()) + 1 if len(same) else 0, len(rank))
    np.minimum.at(least, same, rank)
    earliest = pa.array(rank == least[same])
    return table.filter(earliest), table.filter(pc.invert(earliest))


def shard_repeats(contexts: list[bytes], starts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which starts of a shard are repeats, as a flag for each start, contexts one after the other; the shard's bytes, and where in them each start is.

    ``starts``: strings to judge in each context; ``order``: rank of the contexts by document and place.
    """
    text = np.frombuffer(b"".join(contexts), np.uint8)
    sa, rank = suffix_array(text)
    group = np.cumsum(common_prefixes(text, sa, rank) < SPAN) - 1
    lengths = starts + SPAN - 1
    begins = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(starts)), starts)
    delta = np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
    position = begins[of] + delta
    when = order[of] << 21 | delta
    own = group[rank[position]]
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, own, when)
    return when != least[own], text, position


def _shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated starts; of hot contexts also the strings that are the earliest here."""
    table, copies = distinct_contexts(table)
    yield _ranges(copies)
    doc, uid, first, last = (table.column(k).to_numpy() for k in (1, 2, 3, 4))
    hot = table.column("hot").to_numpy(zero_copy_only=False)
    starts = last - first + 1
    repeated, text, position = shard_repeats(table.column("bytes").to_pylist(), starts, _ranks(table))
    of = np.repeat(np.arange(len(starts)), starts)
    place = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
    # ranges also end where a context ends
    new, over = repeated.copy(), repeated.copy()
    new[1:] &= ~repeated[:-1] | (of[1:] != of[:-1])
    over[:-1] &= ~repeated[1:] | (of[1:] != of[:-1])
    a, b = np.flatnonzero(new), np.flatnonzero(over)
    yield pa.RecordBatch.from_arrays([pa.array(uid[of[a]]), pa.array(place[a]), pa.array(place[b]), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.binary())], schema=_REPEATS)
    open_ = np.flatnonzero(~repeated & hot[of])
    view = np.lib.stride_tricks.sliding_window_view(text, SPAN) if len(open_) else None
    for k in range(0, len(open_), 20_000):
        own = open_[k : k + 20_000]
        flat = np.ascontiguousarray(view[position[own]])
        strings = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SPAN), len(own), [None, pa.py_buffer(flat)]).cast(pa.binary())
        at = pa.array(place[own])
        yield pa.RecordBatch.from_arrays([pa.array(uid[of[own]]), at, at, pa.array(doc[of[own]]), strings], schema=_REPEATS)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, document and place.  A shard ends where a key ends, but a hot key may go on in the next one."""
    held: pa.Table | None = None
    for batch in batches:
        known = batch.column("bytes").is_valid()
        yield _ranges(pa.Table.from_batches([batch.filter(pc.invert(known))]))
        fresh, copies = distinct_contexts(pa.Table.from_batches([batch.filter(known)]))
        yield _ranges(copies)
        held = fresh if held is None else pa.concat_tables([held, fresh])
        while len(held):
            sizes = np.cumsum(pc.binary_length(held.column("bytes")).to_numpy())
            if sizes[-1] <= SHARD:
                break
            fits = max(1, int(np.searchsorted(sizes, SHARD, "right")))
            keys = held.column("key").to_numpy()
            begin = int(np.argmax(keys == keys[fits]))  # the first row of the key that doesn't fit whole
            cut = begin or fits
            yield from _shard(held[:cut])
            held = held[cut:]
    if held is not None and len(held):
        yield from _shard(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of all shards, sorted, equal ones by document and place: all but the first are repeats."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        strings = np.array(batch.column("string").to_pylist(), f"S{SPAN}")
        repeated = np.searchsorted(strings, strings) < np.arange(len(strings))
        repeated |= strings == before if before is not None else False
        before = strings[-1]
        yield _ranges_of(batch, repeated)


def _ranges_of(batch: pa.RecordBatch, chosen: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(chosen)) for k in range(3)], schema=pa.schema(list(_REPEATS)[:3]))


# --- documents ------------------------------------------------------------------------------


def removed_spans(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the strings with these starts cover."""
    if not len(first):
        return []
    order = np.argsort(first)
    a, b = first[order], np.maximum.accumulate(last[order] + SPAN)
    new = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    return list(zip(a[new].tolist(), b[np.append(new[1:], len(a)) - 1].tolist(), strict=True))


def keep_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(raw)], strict=True))


def to_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans shrunk to whole UTF-8 characters."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def find_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list | None = None) -> DataFrame:
    """``__doc`` (doc_id), the columns ``carry``, ``__text``, and ``__ranges``: array<struct<first, last>> of repeated starts, or null."""
    bound_batches(docs.sparkSession)
    buckets = tasks_for(docs)
    chosen = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).cast("string").alias("__text"), *(carry or []))
    rows = chosen.withColumn("__uid", F.monotonically_increasing_id()).repartition(buckets, "__uid")
    base = materialize_by(rows, "suffix-documents", "__uid", buckets)
    runs = materialize(base.select("__uid", "__text").mapInArrow(_anchors, "uid long, first long, last long, hash long, kind byte"), "suffix-runs")
    meeting = runs.where("kind <> 1").repartition("hash").sortWithinPartitions("hash")
    met = materialize(meeting.mapInArrow(_met, "uid long, first long, last long, hash long, salts int"), "suffix-met")
    hot = materialize(met.where("uid is null").select("hash", "salts"), "suffix-hot")  # by itself, so that its size is known
    found = runs.where("kind = 1").union(met.where("uid is not null").withColumn("salts", F.lit(0).cast("byte"))).select("uid", "first", "last", "hash")
    found = found.join(hot, "hash", "left").select("uid", "first", "last", "hash", F.coalesce("salts", F.lit(0)).alias("salts"))
    shared = materialize_by(found.repartition(buckets, "uid"), "suffix-shared", "uid", buckets)
    for made in (runs, met, hot):
        remove(made)
    lists = shared.groupBy("uid").agg(F.collect_list(F.struct("first", "last", "hash", "salts")).alias("runs"))
    order = F.coalesce("__doc", F.lit((1 << 63) - 1))
    joined = base.join(lists, base["__uid"] == lists["uid"]).select(order.alias("doc"), "__uid", "__text", "runs")
    contexts = joined.mapInArrow(_contexts, CONTEXT_DDL).repartition("key").sortWithinPartitions("key", "doc", "uid", "first")
    judged = materialize(contexts.mapInArrow(_shards, REPEATS_DDL), "suffix-repeats")
    remove(shared)
    strings = judged.where("string is not null").repartition("string").sortWithinPartitions("string", "doc", "uid", "first")
    merged = strings.mapInArrow(_merge, "uid long, first long, last long")
    repeats = judged.where("string is null").select("uid", "first", "last").union(merged)
    ranges = repeats.groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("__ranges"))
    return base.join(ranges, base["__uid"] == ranges["uid"], "left").drop("uid", "__uid")


def spans_of(ranges) -> list[tuple[int, int]]:
    if not ranges.is_valid:
        return []
    values = ranges.values
    return removed_spans(values.field(0).to_numpy(), values.field(1).to_numpy())


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document loses, and a digest of what it keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, ranges in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw, spans = (text.as_py() or "").encode(), spans_of(ranges)
                out.append((doc.as_py(), len(raw), sum(b - a for a, b in spans), len(spans), sha256(keep_bytes(raw, spans)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 5, schema, strict=True)], schema=schema)

    found = find_repeats(docs).select("__doc", "__text", "__ranges")
    return found.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
