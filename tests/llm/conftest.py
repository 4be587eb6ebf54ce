import random

import pytest

EDGE = [
    None, "", " ", "a", "\n", "  two  spaces ", " lead", "trail ", "tab\t here", "line\n next\n \nmore  ", "don't I'll we've",
    "<|endoftext|> plain", "éàü ñandú 你好 世界", "mixed 123abc 4,5!! ###", "x" * 3000, "nul\x00byte", "\x1c \x1d sep", "emoji 🙂🙂 ok", " nbsp   em",
]


def _prose(rng, n):
    return " ".join(rng.choice(("the", "of", "thand", "ering", "ouble", "nt,", "shed.", "Whon", "tion")) + rng.choice(("", "", "s", "ed")) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Edge cases, copies, near copies and long texts; (doc_id, text) with a repeated row and a null doc_id."""
    rng = random.Random(5)
    base = [_prose(rng, rng.randint(1, 120)) for _ in range(40)]
    near = []
    for t in base[:10]:
        words = t.split(" ")
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    passage = _prose(rng, 60)
    shared = [f"{_prose(rng, 20)} {passage} {_prose(rng, 5)}" for _ in range(6)]
    found = EDGE + base + base[:7] + near + shared + [_prose(rng, 4000), "be " * 400, "ab" * 300]
    rows = list(enumerate(found))
    return [*rows, rows[25], (None, base[3])]


@pytest.fixture(scope="session")
def frame_of(spark):
    def make(rows, parts=3, **more):
        out = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
        from pyspark.sql import functions as F

        return out.withColumns({k: F.lit(v) for k, v in ({"lang": "en", "source": "s", "n_chars": 1, "size_": 0} | more).items()})

    return make
