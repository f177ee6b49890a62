"""The training corpus pipeline: documents become token ids of clean, distinct, fresh text.

Every stage but the last returns the columns of its input, also columns whose names an operator uses
itself. A row is known by its id, or, if that is null, by a number made of its text, larger than any id
in use; so rows without an id are judged too. No documents give no rows in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm import bpe, decontamination, near_dedup, quality_model, secret_scan
from barograph.llm.common import stored, table, unused, without


def _with_id(docs: DataFrame, name: str) -> DataFrame:
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    return docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), stand_in))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Null and empty texts are scored like any
    other; rows that repeat id and text share a verdict; without labels nothing is rejected."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    verdict = quality_model.quality(keyed, table(spark, sf_dir, "labels"), key_col=key)
    rejected = verdict.where("predicted = 0").select(F.col("key").alias(key))
    return without(keyed, stored(rejected, "rejected"), [key]).select(docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one whose id names the group. Rows that repeat
    id and text become one; texts without words are linked with nothing and stay."""
    ident, text_key = unused(docs, "row_id"), unused(docs, "row_text")
    keyed = _with_id(docs, ident).withColumn(text_key, F.xxhash64("text"))
    verdict = near_dedup.near_duplicates(keyed, id_col=ident)
    verdict = verdict.groupBy(F.col("doc_id").alias(ident), F.col("text_key").alias(text_key)).agg(
        F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    verdict = stored(verdict.where("NOT kept OR n > 1"), "duplicates")
    single = without(keyed, verdict, [ident, text_key])
    repeated = keyed.join(verdict.where("kept"), [ident, text_key]).dropDuplicates([ident, text_key])
    return single.select(docs.columns).unionByName(repeated.select(docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage similar to a benchmark item. Rows that share an id share the verdict;
    null and empty texts stay, and without benchmark items all documents do."""
    ident = unused(docs, "row_id")
    keyed = _with_id(docs, ident)
    found = decontamination.contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=ident)
    leaks = stored(found.select(F.col("doc_id").alias(ident)).distinct(), "leaks")
    return without(keyed, leaks, [ident]).select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a marker. Spans that overlap become one marker; a
    null text stays null, and repeated rows stay."""
    clean = secret_scan.redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): token ids of every document, packed as little-endian 32-bit integers. Null
    and empty texts have no ids; repeated rows and null ids stay."""
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", distinct_texts),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE", tokenised),
]

#: Trained scores, sketches and merges cannot be written as DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is stored and read again. The order of rows is not part of
    the result, and no stage breaks ties by it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
