"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import curriculum, hash_ring, jpeg_media, quality_mil, simhash_trie, suffix_dedup, token_records, token_spans, vptree, word_bpe


def queries() -> dict:
    return {
        "op1_quality": quality_mil.op1_quality,
        "op2_simhash": simhash_trie.op2_simhash,
        "op3_neighbours": vptree.op3_neighbours,
        "op4_token_records": token_records.op4_token_records,
        "op5_sharding": hash_ring.op5_sharding,
        "op6_mixing": curriculum.op6_mixing,
        "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
        "op8_byte_bpe": word_bpe.op8_byte_bpe,
        "op9_token_spans": token_spans.op9_token_spans,
        "op10_media": jpeg_media.op10_media,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_neighbours": vptree.ORACLE, "op6_mixing": curriculum.ORACLE}
