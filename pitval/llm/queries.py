"""The text queries by key, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitval.llm import chunk_dedup, decontaminate, language, merkle, phrases, pieces, quality_lines, sharding, simhash, suffixes, token_counts, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": decontaminate.op1,
    "op2_sharding": sharding.op2,
    "op3_quality_rules": quality_lines.op3,
    "op4_suffix_array_dedup": suffixes.op4,
    "op5_warc": warc.op5,
    "op6_simhash_near_dedup": simhash.op6,
    "op7_language_id": language.op7,
    "op8_url_filters": url_filter.op8,
    "op9_sentencepiece": pieces.op9,
    "op10_token_counts": token_counts.op10,
    "op11_phrase_mining": phrases.op11,
    "op12_exact_dedup": chunk_dedup.op12,
    "op13_merkle_manifest": merkle.op13,
}

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": decontaminate.SQL,
    "op5_warc": warc.SQL,
    "op11_phrase_mining": phrases.SQL,
    "op12_exact_dedup": chunk_dedup.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
