import random

import numpy as np
import xxhash

from tidemark.llm import components
from tidemark.llm import simhash_trie as s
from tidemark.shared import materialize


def brute_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(fps):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def test_fingerprints(texts):
    for _, text in texts:
        assert s.fingerprint(text) == brute_fingerprint(text)


def near(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def sample(rng):
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        fp = rng.getrandbits(64)
        fps |= {fp} | {near(rng, fp, rng.randint(1, 5)) for _ in range(rng.randint(0, 6))}
    hub = rng.getrandbits(64)
    return sorted(fps | {near(rng, hub, rng.randint(1, 3)) for _ in range(150)})


def test_trie_finds_the_components_of_all_pairs():
    rng = random.Random(1)
    for _ in range(5):
        fps = sample(rng)
        left, right = s.trie_links(np.array(fps, np.uint64), np.zeros(len(fps), np.int64))
        assert s.local_roots(len(fps), left, right).tolist() == brute_components(fps)


def test_links_over_buckets_and_hot_buckets(spark):
    fps = sample(random.Random(2))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components(fps)
    for hot in (20_000, 3):
        found = {r.a: r.b for r in s.connected(s.links(table, hot=hot)).collect()}
        groups = {}
        for i, f in enumerate(signed):
            groups.setdefault(found.get(f, f), set()).add(want[i])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_documents(spark, texts, frame_of):
    got = s.link_documents(frame_of(texts), carry=["lang"]).collect()
    fps = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(fps)
    least = {r: min((d for (d, _), q in zip(texts, roots, strict=True) if q == r and d is not None), default=None) for r in set(roots)}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(((d, f, least[q]) for (d, _), f, q in zip(texts, fps, roots, strict=True)), key=key)
    assert sum(r.first for r in got) == len(set(roots)) and all(r.doc_id == r.component_id for r in got if r.first)


def test_empty(spark, frame_of):
    assert s.link_documents(frame_of([])).collect() == []


def test_hubs_are_joined_apart(spark, monkeypatch):
    """A star of many links and chains give the same components, and the rows of hubs the same join."""
    monkeypatch.setattr(components, "HUB", 3)
    edges = [(100 + i, 7) for i in range(20)] + [(i + 1, i) for i in range(200, 210)] + [(105, 300), (300, 301)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.a: r.b for r in components.connected(materialize(frame, "edges")).collect()}
    assert got == {**{100 + i: 7 for i in range(20)}, 300: 7, 301: 7, **{i: 200 for i in range(201, 211)}}
    table = spark.createDataFrame([(7, "seven"), (200, "two"), (5, "none")], "b long, name string")
    plain = sorted(map(tuple, frame.join(table, "b").select("a", "b", "name").collect()))
    assert sorted(map(tuple, components.attach(frame, table, "b").collect())) == plain and len(plain) == 21
