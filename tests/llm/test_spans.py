import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_spans as t

JSON = public_tokenizers.path("byte_bpe_50k.json")


def brute(tokenizer, parts, rule):
    text = "".join(parts)
    of = [k for k, p in enumerate(parts) for _ in p.encode()]
    counts, crossing, at = [0] * len(parts), [0] * len(parts), 0
    for token in tokenizer.encode(text, add_special_tokens=False).tokens:
        own = of[at : at + len(token)]
        at += len(token)
        k = own[0] if rule == "first" else own[-1] if rule == "last" else max(sorted(set(own)), key=own.count)
        counts[k] += 1
        crossing[k] += len(set(own)) > 1
    assert at == len(of)
    return counts, crossing


@pytest.mark.parametrize("rule", t.RULES)
def test_lines(spark, texts, frame_of, rule):
    tokenizer = Tokenizer.from_file(JSON)
    rows = [*texts, (900, "a\n\n\nb\n"), (901, "\n \n\n  x\n\n"), (902, "no end\né\n你\n"), (903, "a <|endoftext|>\n\n<|endoftext|> b\n")]
    want = []
    for doc_id, text in rows:
        parts, at = t.lines(text or ""), 0
        assert "".join(parts) == (text or "")
        for k, (p, n, c) in enumerate(zip(parts, *brute(tokenizer, parts, rule), strict=True)):
            want.append((doc_id, k, at, len(p), n, c))
            at += len(p)
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in t.line_tokens(frame_of(rows, section=1, n_tokens=2), JSON, rule).collect()), key=key) == sorted(want, key=key)


def test_fields_and_empty(spark, frame_of):
    rows = spark.createDataFrame([(1, "user", "hello\n", None), (2, None, "", "x")], "doc_id long, role string, text string, more string")
    got = sorted(tuple(r)[:5] for r in t.field_tokens(rows, "doc_id", ["role", "text", "more"], JSON).collect())
    tokenizer = Tokenizer.from_file(JSON)
    for doc_id, parts in ((1, ["user", "hello\n", ""]), (2, ["", "", "x"])):
        text = "".join(parts)
        assert sum(r[4] for r in got if r[0] == doc_id) == len(tokenizer.encode(text).ids)
        assert [r[3] for r in got if r[0] == doc_id] == [len(p) for p in parts]
    assert t.line_tokens(frame_of([]), JSON).collect() == []
    with pytest.raises(ValueError):
        t.allocate(np.zeros(1, np.int64), np.ones(1, np.int64), "no")
