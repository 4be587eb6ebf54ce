"""The corpus pipeline: quality, near-duplicates, repeated passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``docs``.  Columns that are named
like an operator's own results pass through unharmed, and an empty table gives an
empty table in every stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import curriculum, quality_mil, simhash_trie, suffix_dedup, word_bpe
from tidemark.shared import clean, made, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts have a score like any other and stay or go by it; repeated rows
    share their fate; without a label nothing is learnt, all score 0.5, and all go.
    """
    model = quality_mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_mil.score_documents(docs, model, name="__score")
    return scored.where(F.col("__score") >= quality_mil.CUTOFF).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-equal fingerprints, the one of smallest doc_id stays.

    Null doc_ids come last, and of equal ones (repeated rows) the row that is read first
    stays; texts without words, null ones among them, are one group.
    """
    linked = simhash_trie.link_documents(docs, carry=[F.struct(*docs.columns).alias("__whole")])
    return linked.where("first").select("__whole.*")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document (or place) has go, in whole characters; documents of which nothing is left go too.

    Null and empty texts lose nothing and stay; null doc_ids come last; of repeated rows
    the first one keeps its text.  n_chars follows the text where it was cut.
    """
    others = [c for c in docs.columns if c != "text"]
    found = suffix_dedup.find_repeats(docs, carry=[F.struct(*others).alias("__rest")]).select("__rest", "__text", "__ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if spans := suffix_dedup.spans_of(ranges):
                    raw = text.encode()
                    text = suffix_dedup.keep_bytes(raw, suffix_dedup.to_characters(raw, spans)).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2).is_valid()], ["__rest", "__text", "__cut"])

    schema = T.StructType([found.schema["__rest"], T.StructField("__text", T.StringType()), T.StructField("__cut", T.BooleanType())])
    kept = found.mapInArrow(cut, schema).where("not __cut or __text <> ''")
    columns = [F.col("__text").alias(c) if c == "text" else F.col("__rest")[c].alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns[docs.columns.index("n_chars")] = F.when(F.col("__cut"), F.length("__text").cast(kind)).otherwise(F.col("__rest")["n_chars"]).alias("n_chars")
    return kept.select(*columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in training order: sorted over the files, and by their numbers from file to file.

    Documents are taken whole.  The one that crosses the target of its source is
    taken whole too, so a source may exceed its target by less than one document.
    Documents without words, null texts among them, are never due and go; a null source is a source; repeated
    rows are documents of their own.
    """
    tie = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie")
    whole = docs.select("doc_id", "source", curriculum.word_count(F.col("text")).alias("words"), tie, F.struct(*docs.columns).alias("__whole"))
    mixed = curriculum.mix(whole, size=F.col("words"), tie=F.col("tie"))
    return curriculum.schedule(mixed, ("doc_id", "tie")).select("__whole.*")


def in_file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__place``, the number of each row from 0 in the order of its files; rows of other origin are written first."""
    try:
        file = docs.metadataColumn("_metadata")
        named = docs.select("*", file["file_name"].alias("__file"), file["row_index"].alias("__at"))
    except AnalysisException:
        return in_file_order(materialize(docs, "in-order"))
    counts = named.groupBy("__file").agg(F.count("*").alias("n"))  # a row for each file
    total = F.expr("coalesce(sum(n) over (order by __file rows between unbounded preceding and 1 preceding), 0)")
    starts = materialize(counts.select("__file", total.alias("__from")), "file-starts")
    return named.join(starts, "__file").withColumn("__place", F.col("__from") + F.col("__at")).drop("__file", "__at", "__from")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of what they decode to, with ``place``, its number in the training order, and sorted by it.

    Null and empty texts have no ids; repeated rows have a row each.
    """
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return word_bpe.encode_in_order(in_file_order(docs), ranks, public_tokenizers.PATTERN, F.col("__place"), max(docs.count(), 1))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The classifier, the linking of fingerprints and the suffix arrays are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet and read again, and what it made on the way is deleted."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), made()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        clean(spark, since, but=(docs,))
    return docs
