import random
import re
from hashlib import sha256

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tidemark import shared
from tidemark.llm import curriculum, word_bpe


def table(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "of", "and", "in", "a"]) if rng.random() < 0.4 else "".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    passage = prose(70)
    rows = []
    for i in range(160):
        text = prose(rng.randint(30, 200))
        if i % 5 == 4:
            text = (word() + " ") * 120
        elif i % 11 == 0:
            text = f"{text} {passage} é{prose(9)}"
        elif i % 13 == 0 and i and (i // 2) % 5 != 4:
            text = rows[i // 2][1]
        rows.append((i, text, "en", f"s{i % 4}" if i % 7 else None, len(text or ""), i, "x"))
    rows += [(500, None, "en", "s0", 0, 1, "x"), (501, "", "en", "s1", 0, 1, "x"), rows[3], (None, prose(60), None, "s0", 1, 1, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, first string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 5 != 4), 0) for i in range(0, 160)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    table(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    seen = [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert docs.columns == columns
        if k == 4:
            seen.append(docs.collect())
            break
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.collect())
    start, good, single, cut, mixed, final = seen

    kept = {r.doc_id for r in good}
    assert all(i in kept for i in range(160) if i % 5 != 4) and sum(i in kept for i in range(160) if i % 5 == 4) <= 3
    assert all(r in start for r in good)

    roots = brute_components([brute_fingerprint(r.text) for r in good])
    assert len(single) == len(set(roots)) and len({roots[good.index(r)] for r in single}) == len(single)
    assert all(r.doc_id == min((g.doc_id for g, q in zip(good, roots, strict=True) if q == roots[good.index(r)] and g.doc_id is not None), default=None) for r in single)

    grams, want = set(), {}
    for r in sorted(single, key=lambda r: (r.doc_id is None, r.doc_id)):
        raw, gone = (r.text or "").encode(), set()
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in grams:
                gone.update(range(i, i + 100))
            grams.add(raw[i : i + 100])
        kept, inside, tail = bytearray(), False, bytearray()
        for i, b in enumerate(raw):  # a character goes only if all its bytes go
            if b & 0xC0 != 0x80:
                kept += tail if not inside else b""
                tail, inside = bytearray(), True
            tail.append(b)
            inside = inside and i in gone
        kept += tail if not inside else b""
        want[r.doc_id] = (kept.decode(), bool(gone))
    assert {r.doc_id: r.text or "" for r in cut} == {d: left for d, (left, gone) in want.items() if left or not gone}
    assert any(gone and left for left, gone in want.values())
    for r in cut:
        assert not want[r.doc_id][1] or r.n_chars == len(r.text)

    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in cut}
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert r in cut
    total = sum(words.values())
    assert max(times.values()) <= 2 and abs(sum(words[d] * n for d, n in times.items()) - 1.5 * total) < 0.1 * total

    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    lines = sorted((str(r.doc_id), encoder.encode_ordinary(r.text)) for r in mixed)
    assert sorted((str(r.doc_id), r.tokens) for r in final) == lines
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in final) == sorted((str(r.doc_id), sha256(r.text.encode()).hexdigest()) for r in mixed)

    # the training order goes on to the end
    due = curriculum.mix(spark.read.parquet(str(tmp_path / "repeats")).select("doc_id", "source", "text")).collect()
    order = [d for _, _, d in sorted((p, (r.doc_id is not None, r.doc_id), r.doc_id) for r in due for p in r.positions)]
    assert [r.doc_id for r in final] == order and [r.place for r in final] == list(range(len(order)))
    again = corpus_pipeline.in_file_order(spark.createDataFrame([(i, "x") for i in range(50)], "doc_id long, __file string").repartition(3, "doc_id").drop("__file"))
    assert sorted(r["__place"] for r in again.collect()) == list(range(50))


def test_run_leaves_only_its_result(spark, tmp_path):
    table(spark, tmp_path)
    before = {t.name for t in spark.catalog.listTables()}, shared.made()
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert ({t.name for t in spark.catalog.listTables()}, shared.made()) == (before[0], before[1] + 1)
    places = [r.place for r in got.select("place").collect()]
    assert sorted(places) == list(range(len(places)))


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
