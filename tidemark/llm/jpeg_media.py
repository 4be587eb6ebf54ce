"""Baseline JPEG in numpy: lossless storage of bytes as luminance, and DC-only thumbnails.

Reading: markers are parsed, the scan is cut at its restart markers, and the
segments of many images are Huffman-decoded together, one block of each per step.
Only DC coefficients are kept, AC codes are passed over; the DC of a block is the
mean of its 64 samples, so they make a luminance thumbnail of an eighth of the
size.  Any baseline file will do (grey or colour, any sampling, with or without
restart markers); progressive and arithmetic-coded ones are refused.

Writing: a payload byte becomes a block of constant luminance, 64 blocks a row,
quantised by 8, so that the thumbnail of the stored image *is* the payload.  Every
row of blocks ends with a restart marker.  An image holds up to 8,191 rows of blocks; longer
payloads are several images, one after the other.

Edge cases: null and empty texts are a payload of 64 zero bytes; texts of any
length are encoded in slices of ``SLICE`` bytes; equal texts have equal files;
repeated rows give a row each; an empty table gives an empty table; other columns,
whatever their names, are not read.

What is stored is the JPEG file, a cell of the column ``media``; it is read back by parsing
that cell's bytes, which know nothing of the text.  ``media_column`` may be written as a
table and ``media_features`` read it; the query hands the column on without that, as the
files of a text take more room than the text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import bound_batches

ROW = 64  # payload bytes, and blocks, in a row
MAX_ROWS = 8191  # 8 * 8,191 is the greatest height below 65,536 that is a multiple of 8
SLICE = 1 << 20
#: Code lengths of the DC categories 0 to 8, for the differences between letters of a text.
DC_LENGTHS = (5, 4, 3, 3, 2, 3, 6, 2, 7)


# --- Huffman tables -------------------------------------------------------------------------


def canonical(lengths: dict[int, int]) -> tuple[list[int], list[int], dict[int, int]]:
    """Counts of codes of 1 to 16 bits, symbols in the order of their codes, and the codes."""
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    counts, codes, code, last = [0] * 16, {}, 0, 0
    for s in symbols:
        code <<= lengths[s] - last
        last = lengths[s]
        codes[s] = code
        code += 1
        counts[last - 1] += 1
    return counts, symbols, codes


def lookup(counts: list[int], symbols: list[int]) -> np.ndarray:
    """For every 16 bits: length of the code they begin with times 256, plus its symbol; 0 if none."""
    table = np.zeros(1 << 16, np.int64)
    code, k = 0, 0
    for bits in range(1, 17):
        for _ in range(counts[bits - 1]):
            table[code << (16 - bits) : (code + 1) << (16 - bits)] = bits << 8 | symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return table


_DC_COUNTS, _DC_SYMBOLS, _DC_CODES = canonical(dict(enumerate(DC_LENGTHS)))
_AC_COUNTS, _AC_SYMBOLS, _AC_CODES = canonical({0: 1})


def _words() -> tuple[np.ndarray, np.ndarray]:
    """Code word and its length for each difference -255 to 255: category, extra bits, end of block."""
    word, length = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        extra = d if d >= 0 else d + (1 << size) - 1
        word[d + 255] = (_DC_CODES[size] << size | extra) << 1 | _AC_CODES[0]
        length[d + 255] = DC_LENGTHS[size] + size + 1
    return word, length


_WORD, _LENGTH = _words()


# --- writing --------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(rows: int, comment: bytes) -> bytes:
    return b"".join((
        b"\xff\xd8",
        _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"),
        _segment(0xFE, comment),
        _segment(0xDB, b"\0" + bytes([8] * 64)),
        _segment(0xC0, struct.pack(">BHHB", 8, 8 * rows, 8 * ROW, 1) + b"\1\x11\0"),
        _segment(0xC4, b"\0" + bytes(_DC_COUNTS) + bytes(_DC_SYMBOLS)),
        _segment(0xC4, b"\x10" + bytes(_AC_COUNTS) + bytes(_AC_SYMBOLS)),
        _segment(0xDD, struct.pack(">H", ROW)),
        _segment(0xDA, b"\1\1\0\0\x3f\0"),
    ))


def encode_rows(samples: np.ndarray, row_of_image: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Entropy-coded rows of 64 samples, a restart marker before each but the first of an image; and where each ends."""
    n = len(samples)
    dc = samples.astype(np.int64) - 128
    diff = dc.copy()
    diff[:, 1:] -= dc[:, :-1]
    diff += 255
    length = np.empty((n, ROW + 1), np.int64)
    length[:, :ROW] = _LENGTH[diff]
    length[:, ROW] = -length[:, :ROW].sum(1) % 8
    word = np.empty((n, ROW + 1), np.uint64)
    word[:, :ROW] = _WORD[diff]
    word[:, ROW] = (1 << length[:, ROW]) - 1  # a row is filled up with ones
    sizes = length.sum(1) // 8
    length, word = length.ravel(), word.ravel()
    ends = np.cumsum(length)
    begins = ends - length
    own = begins >> 6
    free = 64 - (begins & 63) - length  # bits left in the word of 64; negative if the code goes on in the next
    over = free < 0
    first = np.where(over, word >> np.where(over, -free, 0).astype(np.uint64), word << np.where(over, 0, free).astype(np.uint64))
    total = int(ends[-1])
    packed = np.zeros(total // 64 + 2, np.uint64)
    start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    packed[own[start]] = np.bitwise_or.reduceat(first, start)
    packed[own[over] + 1] |= word[over] << (64 + free[over]).astype(np.uint64)
    stream = packed.astype(">u8").view(np.uint8)[: total // 8]
    marked = 2 * (row_of_image > 0)
    full = stream == 255
    shift = np.cumsum(full) - full + np.repeat(np.cumsum(marked), sizes)
    out = np.zeros(len(stream) + int(full.sum()) + int(marked.sum()), np.uint8)
    at = np.arange(len(stream)) + shift
    out[at] = stream
    last = np.cumsum(sizes) - 1
    stop = at[last] + 1 + full[last]
    begin = np.append(0, stop[:-1])[row_of_image > 0]
    out[begin] = 255
    out[begin + 1] = 0xD0 + (row_of_image[row_of_image > 0] - 1) % 8
    return out.tobytes(), stop


def pad(raw: bytes) -> bytes:
    """With zero bytes up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % ROW if raw else ROW)


def store(payloads: list[bytes], sizes: list[int]) -> list[bytes]:
    """The JPEG file of each payload (a multiple of 64 bytes); ``sizes`` go to the comment."""
    parts: list[list[bytes]] = [[] for _ in payloads]
    jobs: list[tuple[int, int, int]] = []  # payload, first row of a slice, rows
    for i, p in enumerate(payloads):
        rows = len(p) // ROW
        for a in range(0, rows, MAX_ROWS):
            jobs.append((i, a, min(MAX_ROWS, rows - a)))
    k = 0
    while k < len(jobs):
        last, size = k, 0
        while last < len(jobs) and (size == 0 or size + jobs[last][2] * ROW <= SLICE):
            size += jobs[last][2] * ROW
            last += 1
        group = jobs[k:last]
        samples = np.frombuffer(b"".join(payloads[i][a * ROW : (a + n) * ROW] for i, a, n in group), np.uint8).reshape(-1, ROW)
        data, stop = encode_rows(samples, np.concatenate([np.arange(n) for _, _, n in group]))
        at = row = 0
        for i, _, n in group:
            row += n
            end = int(stop[row - 1])
            parts[i] += [header(n, b"bytes %d" % sizes[i]), data[at:end], b"\xff\xd9"]
            at = end
        k = last
    return [b"".join(p) for p in parts]


# --- reading --------------------------------------------------------------------------------


class Image:
    """What the markers of one baseline image say, and its entropy-coded segments."""

    def __init__(self) -> None:
        self.height = self.width = self.interval = 0
        self.comments: list[bytes] = []
        self.quant: dict[int, int] = {}  # of the DC
        self.tables: dict[int, tuple] = {}  # class * 16 + number: counts and symbols
        self.parts: list[tuple[int, int, int, int]] = []  # id, horizontal and vertical sampling, quantisation table
        self.scan: list[tuple[int, int, int]] = []  # component, DC and AC table
        self.segments: list[bytes] = []

    def blocks(self) -> tuple[list[int], int, int]:
        """Component of each block of an MCU, and MCUs across and down."""
        if len(self.scan) == 1:
            k = self.scan[0][0]
            widest, tallest = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
            across = -(-self.width * self.parts[k][1] // (8 * widest))
            return [0], across, -(-self.height * self.parts[k][2] // (8 * tallest))
        plan = [j for j, (k, _, _) in enumerate(self.scan) for _ in range(self.parts[k][1] * self.parts[k][2])]
        return plan, -(-self.width // (8 * max(p[1] for p in self.parts))), -(-self.height // (8 * max(p[2] for p in self.parts)))


def parse(data: bytes) -> list[Image]:
    """The images of a file that holds one or more baseline images one after the other."""
    raw = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero(raw[:-1] == 255)
    kinds = raw[marks + 1]
    restart = (kinds >= 0xD0) & (kinds <= 0xD7)
    stops = marks[(kinds != 0) & ~restart & (kinds != 255)]
    restarts = marks[restart]
    images: list[Image] = []
    image: Image | None = None
    at = 0
    while at + 1 < len(data):
        if data[at] != 255:
            raise ValueError(f"no marker at byte {at}")
        marker = data[at + 1]
        if marker == 255:
            at += 1
            continue
        if marker == 0xD8:
            image = Image()
            at += 2
            continue
        if image is None:
            raise ValueError("not a JPEG file")
        if marker == 0xD9:
            images.append(image)
            image = None
            at += 2
            continue
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            image.comments.append(body)
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                image.quant[body[0] & 15] = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                counts = list(body[1:17])
                image.tables[body[0]] = (tuple(counts), tuple(body[17 : 17 + sum(counts)]))
                body = body[17 + sum(counts) :]
        elif marker == 0xC0 or marker == 0xC1:
            bits, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("only 8-bit samples")
            image.parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError(f"not baseline: frame type {marker:#x}")
        elif marker == 0xDD:
            image.interval = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            ids = [p[0] for p in image.parts]
            scan = [(ids.index(body[1 + 2 * k]), body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            k = int(np.searchsorted(stops, at))
            end = int(stops[k]) if k < len(stops) else len(data)
            if scan[0][0] == 0:  # the scan of the luminance
                image.scan = scan
                inner = restarts[np.searchsorted(restarts, at) : np.searchsorted(restarts, end)].tolist()
                image.segments = [data[a:b] for a, b in zip([at, *(r + 2 for r in inner)], [*inner, end], strict=True)]
            at = end
    if image is not None:
        raise ValueError("the file ends within an image")
    return images


def decode_dc(images: list[Image]) -> list[np.ndarray]:
    """DC coefficients, not yet dequantised, of each image: MCU by block of the MCU.  All images share tables and sampling."""
    one = images[0]
    plan, _, _ = one.blocks()
    dc = [lookup(*map(list, one.tables[t])) for _, t, _ in one.scan]
    ac = [lookup(*map(list, one.tables[16 + t])) for _, _, t in one.scan]
    counts, shapes, pieces = [], [], []
    for image in images:
        _, across, down = image.blocks()
        whole = across * down
        each = image.interval or whole
        need = -(-whole // each)
        if len(image.segments) != need:
            raise ValueError(f"{len(image.segments)} segments for {need} restart intervals")
        counts += [each] * (need - 1) + [whole - each * (need - 1)]
        shapes.append((whole, need))
        pieces += image.segments
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    kept = np.ones(len(raw), bool)
    kept[1:] = ~((raw[1:] == 0) & (raw[:-1] == 255))
    clean = np.concatenate([raw[kept], np.full(16, 255, np.uint8)])
    before = np.concatenate([[0], np.cumsum(kept)])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    bit = 8 * before[edges[:-1]]
    limit = 8 * before[edges[1:]]
    window = np.zeros(len(clean) - 8, np.uint64)
    for k in range(5):
        window |= clean[k : len(clean) - 8 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    blocks = np.array(counts, np.int64) * len(plan)
    order = np.argsort(-blocks, kind="stable")
    bit, limit, blocks = bit[order], limit[order], blocks[order]
    out = np.zeros((len(blocks), int(blocks[0]) if len(blocks) else 0), np.int16)
    last = np.zeros((len(one.scan), len(blocks)), np.int64)
    live = len(blocks)

    def symbol(table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        view = window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint64)
        found = table[(view >> np.uint64(48)).astype(np.int64)]
        if not found.all():
            raise ValueError("no such Huffman code")
        return view, found >> 8, found & 255, found & 15

    for b in range(out.shape[1]):
        while live and blocks[live - 1] <= b:
            live = int(np.searchsorted(-blocks[:live], -b, "left"))
        comp = plan[b % len(plan)]
        at = bit[:live]
        view, code, _, size = symbol(dc[comp], at)
        extra = ((view << code.astype(np.uint64)) >> (np.uint64(63) - size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
        low = (size > 0) & (extra < (1 << np.maximum(size - 1, 0)))
        last[comp, :live] += np.where(low, extra - (1 << size) + 1, extra)
        out[:live, b] = last[comp, :live]
        at = at + code + size
        todo, place = np.arange(live), np.ones(live, np.int64)
        while len(todo):
            _, code, name, size = symbol(ac[comp], at[todo])
            at[todo] += code + size
            place = place + (name >> 4) + 1
            more = ((name != 0) | (size != 0)) & (place < 64)
            todo, place = (todo[more], place[more]) if not more.all() else (todo, place)
        bit[:live] = at
    if (bit > limit).any():
        raise ValueError("a segment ends too early")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    found, k = [], 0
    sizes = np.array(counts, np.int64) * len(plan)
    for whole, need in shapes:
        rows = back[k : k + need]
        flat = out[rows[0]][: sizes[k]] if need == 1 else np.concatenate([out[rows[:-1]][:, : sizes[k]].ravel(), out[rows[-1]][: sizes[k + need - 1]]])
        found.append(flat.reshape(whole, len(plan)))
        k += need
    return found


def thumbnails(images: list[Image]) -> list[np.ndarray]:
    """The DC-only luminance of each image, a sample for each block of 8 by 8."""
    out: list[np.ndarray | None] = [None] * len(images)
    alike: dict[tuple, list[int]] = {}
    for k, image in enumerate(images):
        key = (tuple(image.parts), tuple(image.scan), tuple(sorted(image.tables.items())))
        alike.setdefault(key, []).append(k)
    for numbers in alike.values():
        for k, dc in zip(numbers, decode_dc([images[k] for k in numbers]), strict=True):
            image = images[k]
            plan, across, down = image.blocks()
            _, h, v, table = image.parts[0]
            if len(plan) == 1 and len(image.scan) == 1:
                h = v = 1
            grid = dc[:, : h * v].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            tall, wide = max(p[2] for p in image.parts), max(p[1] for p in image.parts)
            rows, columns = -(-image.height * image.parts[0][2] // (8 * tall)), -(-image.width * image.parts[0][1] // (8 * wide))
            light = np.floor(grid[:rows, :columns].astype(np.float64) * image.quant[table] / 8 + 128.5)
            out[k] = np.clip(light, 0, 255).astype(np.uint8)
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """Average hash and gradient hash of a thumbnail, each of 64 bits, over a grid of eight by eight (nine) means."""

    def means(rows: int, columns: int) -> np.ndarray:
        total = thumb.astype(np.float64)
        for axis, n in ((0, rows), (1, columns)):
            edge = np.arange(n) * total.shape[axis] // n
            size = np.maximum(np.append(edge[1:], total.shape[axis]) - edge, 1)
            total = np.add.reduceat(total, edge, axis=axis) / (size[:, None] if axis == 0 else size)
        return total

    grid, wide = means(8, 8), means(8, 9)
    bits = lambda x: np.packbits(x.ravel()).tobytes().hex()
    return f"{bits(grid > grid.mean())}:{bits(wide[:, 1:] > wide[:, :-1])}"


# --- the column -----------------------------------------------------------------------------


def media_column(docs: DataFrame, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_bytes and media: the text as a JPEG file."""
    bound_batches(docs.sparkSession, megabytes=4)
    chosen = docs.select(F.col(text).cast("string").alias("__text"), *keep)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column(0).to_pylist()]
            sizes = [len(r) for r in raw]
            media = store([pad(r) for r in raw], sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], [*batch.schema.names[1:], "n_bytes", "media"])

    return chosen.mapInArrow(write, T.StructType([*chosen.schema.fields[1:], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))


_FEATURES = pa.schema([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("width", pa.int32()), ("height", pa.int64()), ("feature", pa.string())])


def read_media(files: list[bytes]) -> Iterator[tuple[list[Image], np.ndarray]]:
    """Images of each file and its thumbnail (those of several images one below the other)."""
    parsed = [parse(f) for f in files]
    flat = [image for images in parsed for image in images]
    thumbs: list[np.ndarray] = []
    k = 0
    while k < len(flat):
        last, size = k, 0
        while last < len(flat) and (size == 0 or size + flat[last].height * flat[last].width // 64 <= SLICE):
            size += flat[last].height * flat[last].width // 64
            last += 1
        thumbs += thumbnails(flat[k:last])
        k = last
    k = 0
    for images in parsed:
        own = thumbs[k : k + len(images)]
        k += len(images)
        yield images, own[0] if len(own) == 1 else np.concatenate(own)


def media_features(media: DataFrame) -> DataFrame:
    """``media`` without its files, with their dimensions, thumbnail hashes and the digests of what they hold."""
    names = [c for c in media.columns if c != "media"]
    at = media.columns.index("media")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, out = batch.column(at).to_pylist(), []
            for data, (images, thumb) in zip(files, read_media(files), strict=True):
                payload = thumb.tobytes()
                width, height = images[0].width, sum(i.height for i in images)
                out.append((len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), sha256(data).hexdigest(), width, height, f"{width}x{height}:{thumbnail_hash(thumb)}"))
            columns = zip(*out, strict=True) if out else [()] * 8
            rest = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c, f.type) for c, f in zip(columns, _FEATURES, strict=True))], [*names, *_FEATURES.names])

    features = T.StructType.fromDDL("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width int, height long, feature string")
    return media.mapInArrow(look, T.StructType([*(media.schema[c] for c in names), *features.fields]))


def op10_media(spark, sf_dir: str) -> DataFrame:
    """Every document stored as JPEG and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    return media_features(media_column(docs)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")
