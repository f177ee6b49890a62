"""The training-data operators as named queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm import (
    bpe,
    compression_rules,
    decontamination,
    language_id,
    license_scan,
    lm_scoring,
    near_dedup,
    packing,
    quality_model,
    secret_scan,
    sharding,
    source_audit,
    sql,
    whitening,
)
from barograph.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every document, decode the ids, and digest both."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.digests(bpe.encode(table(spark, folder, "documents"), path, pattern, decoded=True))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against documents labelled as good."""
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, folder, "documents"), good)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality_model.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scores.drop("key")


def op5_compression_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and the verdict: few words or many repeats fail before the bands are asked."""
    rows = compression_rules.compression_rules(table(spark, folder, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("in_bands")).alias("kept"),
        "whole_ratio", "least_chunk_ratio", "most_chunk_ratio", "chunks", "chunks_outside",
    )


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(table(spark, folder, "documents"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents")).drop("text_key")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Matches of every document, written as notice:coverage in percent:first word:end."""
    found = license_scan.license_scan(table(spark, folder, "documents"))
    listed = F.transform(
        "matches",
        lambda m: F.concat_ws(
            ":", m["license"], F.round(100 * m["coverage"]).cast("int"), m["first_word"], m["end_word"]
        ),
    )
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        "license",
        "coverage",
        F.array_join(listed, ",").alias("matches"),
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, folder, "documents")))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The four leading components of every embedding."""
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(table(spark, folder, "documents"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of 2048 tokens, ids as checksums."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.digests(packing.packed(table(spark, folder, "documents"), path))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_sharding": op2_sharding,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality": op4_quality,
    "op5_compression_rules": op5_compression_rules,
    "op6_language": op6_language,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_licenses": op8_licenses,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_whitening": op11_whitening,
    "op12_source_audit": op12_source_audit,
    "op13_packing": op13_packing,
}

#: DuckDB SQL by query, where SQL can express the operator.
CHECKS: dict[str, str] = {
    "op7_near_duplicates": sql.NEAR_DUPLICATES,
    "op9_decontamination": sql.DECONTAMINATION,
    "op12_source_audit": sql.SOURCE_AUDIT,
}
