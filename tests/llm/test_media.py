import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tidemark.llm import jpeg_media as j
from tidemark.shared import materialize


def brute_dc(image):
    """A bit-by-bit decoder of the scan: DC of each block of each MCU."""
    codes = {}
    for name, (counts, symbols) in image.tables.items():
        code, k, own = 0, 0, {}
        for bits in range(16):
            for _ in range(counts[bits]):
                own[(bits + 1, code)] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        codes[name] = own
    plan, across, down = image.blocks()
    out = []
    for segment in image.segments:
        bits = "".join(f"{b:08b}" for b in segment.replace(b"\xff\0", b"\xff"))
        at, last = 0, [0] * len(image.scan)

        def symbol(table):
            nonlocal at
            for n in range(1, 17):
                if (n, int(bits[at : at + n], 2)) in table:
                    at += n
                    return table[(n, int(bits[at - n : at], 2))]
            raise ValueError

        def number(size):
            nonlocal at
            at += size
            x = int(bits[at - size : at] or "0", 2)
            return x if not size or x >> (size - 1) else x - (1 << size) + 1

        left = across * down - len(out)
        for _ in range(min(left, image.interval or left)):
            row = []
            for comp in plan:
                last[comp] += number(symbol(codes[image.scan[comp][1]]))
                row.append(last[comp])
                k = 1
                while k < 64:
                    s = symbol(codes[16 + image.scan[comp][2]])
                    if s == 0:
                        break
                    k += (s >> 4) + 1
                    number(s & 15)
            out.append(row)
    return np.array(out)


def colour_file(rng, interval):
    """A three-component image with 2x2 luminance sampling and random AC coefficients."""
    dc = {s: 4 for s in range(12)}
    ac = {0: 2, 0xF0: 3} | {r << 4 | s: 8 for r in range(6) for s in (1, 2, 3, 5)}
    tables = [j.canonical(t) for t in (dc, ac)]
    width, height, plan = 37, 50, [0, 0, 0, 0, 1, 2]
    mcus = -(-width // 16) * -(-height // 16)
    scan, bits, last = b"", "", [0, 0, 0]

    def put(kind, symbol, lengths):
        return f"{tables[kind][2][symbol]:0{lengths[symbol]}b}"

    def flush(bits):
        bits += "1" * (-len(bits) % 8)
        return bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")

    for m in range(mcus):
        if interval and m and m % interval == 0:
            scan += flush(bits) + bytes([255, 0xD0 + (m // interval - 1) % 8])
            bits, last = "", [0, 0, 0]
        for c in plan:
            v = rng.randint(-200, 200)
            d, last[c] = v - last[c], v
            size = abs(d).bit_length()
            bits += put(0, size, dc) + (f"{d if d > 0 else d + (1 << size) - 1:0{size}b}" if size else "")
            k = 1
            while k < 60 and rng.random() < 0.7:
                s = rng.choice([x for x in ac if x])
                k += (s >> 4) + 1
                if k > 63:
                    break
                bits += put(1, s, ac) + "".join(rng.choice("01") for _ in range(s & 15))
            bits += put(1, 0, ac)
    scan += flush(bits)
    import struct

    out = b"\xff\xd8" + j._segment(0xDB, b"\0" + bytes([16] * 64)) + j._segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + b"\1\x22\0\2\x11\0\3\x11\0")
    for kind, t in enumerate(tables):
        out += j._segment(0xC4, bytes([kind << 4, *t[0], *t[1]]))
    if interval:
        out += j._segment(0xDD, struct.pack(">H", interval))
    return out + j._segment(0xDA, b"\3\1\0\2\0\3\0\0\x3f\0") + scan + b"\xff\xd9"


@pytest.mark.parametrize("interval", [0, 1, 5])
def test_colour_images(interval):
    rng = random.Random(interval)
    images = [i for _ in range(4) for i in j.parse(colour_file(rng, interval))]
    for image, dc, thumb in zip(images, j.decode_dc(images), j.thumbnails(images), strict=True):
        want = brute_dc(image)
        assert (dc == want).all() and thumb.shape == (7, 5)
        light = lambda y, x: min(255, max(0, int(np.floor(want[(y // 2) * 3 + x // 2][y % 2 * 2 + x % 2] * 16 / 8 + 128.5))))
        assert all(thumb[y, x] == light(y, x) for y in range(7) for x in range(5))


def test_round_trip_and_bitwise_decoder():
    rng = random.Random(2)
    payloads = [j.pad(b""), j.pad(bytes(range(256))), bytes([255, 0] * 64), j.pad(bytes(rng.randrange(256) for _ in range(5000))), bytes([1, 254] * 32 * 8200)]
    files = j.store(payloads, [len(p) for p in payloads])
    for (images, thumb), payload in zip(j.read_media(files), payloads, strict=True):
        assert thumb.tobytes() == payload and thumb.shape[1] == 64
        assert all(i.width == 512 for i in images) and images[0].comments == [b"bytes %d" % len(payload)]
    assert len(j.parse(files[-1])) == 2
    image = j.parse(files[3])[0]
    assert (brute_dc(image).ravel() + 128).astype(np.uint8).tobytes() == payloads[3]


def test_refusals():
    file = j.store([bytes(64)], [1])[0]
    with pytest.raises(ValueError, match="not baseline"):
        j.parse(file.replace(b"\xff\xc0", b"\xff\xc2"))
    with pytest.raises(ValueError):
        j.parse(b"\0" + file)
    with pytest.raises(ValueError):
        j.parse(file[:-2])


def test_query(spark, texts, frame_of, tmp_path):
    frame_of(texts, n_bytes=1, media="x", payload_bytes=2, feature=3).write.parquet(str(tmp_path / "documents.parquet"))
    got = j.op10_media(spark, str(tmp_path)).collect()
    want = []
    for doc_id, text in texts:
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        want.append((doc_id, len(raw), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert len({(r.payload_sha256, r.n_bytes) for r in got}) == len({(r.media_sha256, r.media_bytes, r.feature, r.n_bytes) for r in got})
    # the same from files that lie in a table
    written = materialize(j.media_column(spark.read.parquet(str(tmp_path / "documents.parquet"))), "media")
    again = j.media_features(written).select(got[0].__fields__[:-2] + ["width", "height"]).collect()
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, got), key=key)
    assert j.media_features(j.media_column(frame_of([]))).collect() == []
