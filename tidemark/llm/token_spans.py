"""Token counts of the parts of a document, by one encoding of the whole.

The parts (lines of a text, or fields joined to one) are consecutive spans of the
document.  The document is encoded once, as a model would see it; every token is
a span of bytes, and an interval join by binary search on the parts' first bytes
finds the part in which each token begins and ends.  A token that crosses a
boundary is allocated by ``rule``:

* ``most``: to the part that holds most of its bytes, the earlier one of equals;
* ``first``: to the part that holds its first byte;
* ``last``: to the part that holds its last byte.

So the counts of the parts add up to the tokens of the document.

Edge cases: null and empty texts are one empty part without tokens; an empty part (a field without text) has
none; repeated rows give their rows each; texts of any length are encoded whole;
an empty table gives an empty table; only the named columns are read,
whatever the names of others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.token_records import encoder
from tidemark.shared import bound_batches

RULES = ("most", "first", "last")
OUT = "doc_id long, section int, first_char long, n_chars long, n_tokens long, n_crossing long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("first_char", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])


def allocate(begins: np.ndarray, lengths: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each part, and those among them that cross a boundary.

    ``begins``: the first byte of each part, ascending, the first 0; ``lengths``: the bytes of each token.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    parts = len(begins)
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    first = np.searchsorted(begins, starts, "right") - 1
    last = np.searchsorted(begins, ends - 1, "right") - 1
    chosen = last.copy() if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        stop = np.append(begins[1:], ends[-1] if len(ends) else 0)
        for k in crossing:
            own = np.arange(first[k], last[k] + 1)
            held = np.minimum(stop[own], ends[k]) - np.maximum(begins[own], starts[k])
            chosen[k] = own[int(np.argmax(held))]
    return np.bincount(chosen, minlength=parts), np.bincount(chosen[crossing], minlength=parts)


def lines(text: str) -> list[str]:
    """The lines of a text, each with its line feed; one empty line if there is none."""
    parts = text.split("\n")
    parts = [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    return parts or [""]


def _counter(tokenizer_path: str, rule: str, split):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encode = encoder(tokenizer_path)
        tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary, added = tokenizer.get_vocab(), tokenizer.get_added_tokens_decoder()
        size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            size[i] = len(token)  # a byte-level vocabulary writes one character for each byte
        for i, token in added.items():
            size[i] = len(token.content.encode())  # but added tokens are written as they are
        for batch in batches:
            ids, cut = batch.column(0).to_pylist(), [split(cell or "") for cell in batch.column(1).to_pylist()]
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            owner, counts = [], []
            for doc_id, parts, tokens in zip(ids, cut, encode(["".join(parts) for parts in cut]), strict=True):
                chars = np.fromiter(map(len, parts), np.int64, len(parts))
                held = np.fromiter((len(p.encode()) for p in parts), np.int64, len(parts))
                n, crossing = allocate(np.cumsum(held) - held, size[np.frombuffer(tokens, "<u4")], rule)
                for c, x in zip(columns, (np.arange(len(parts)), np.cumsum(chars) - chars, chars, n, crossing), strict=True):
                    c.append(x)
                owner.append(doc_id)
                counts.append(len(parts))
            which = np.repeat(np.arange(len(counts)), counts)
            arrays = [pa.array(owner, pa.int64()).take(pa.array(which)), *(pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, _SCHEMA, strict=True)], schema=_SCHEMA)

    return count


def line_tokens(docs: DataFrame, tokenizer_path: str, rule: str = "most") -> DataFrame:
    """doc_id, section (line number from 0), its characters, n_tokens, and how many of them cross its boundary."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_counter(tokenizer_path, rule, lines), OUT)


def field_tokens(rows: DataFrame, doc_id: str, fields: list[str], tokenizer_path: str, rule: str = "most") -> DataFrame:
    """The same for the named fields of each row (null: empty), read one after the other as one document."""
    bound_batches(rows.sparkSession)
    cells = F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    return rows.select(F.col(doc_id).cast("long").alias("doc_id"), cells.alias("parts")).mapInArrow(_counter(tokenizer_path, rule, list), OUT)


def op9_token_spans(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers

    return line_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
