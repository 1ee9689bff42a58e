"""One query per operator of this subpackage, and the SQL that gives the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat, decontam, jaccard, lines, manifest, merkle, phrases, quality, suffix, topk, urls
from ledgerloom.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"), lines.WINDOW, lines.LONG_WORDS)
    return found.select("row.doc_id", "text", "n_lines", "n_removed")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(suffix.dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), *urls.rule_frames(spark))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_chats(chat.text_messages(rows.unionByName(extra))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "held_out", F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_fingerprints(table(spark, sf_dir, "documents"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_chat_format": op5_chat_format,
    "op6_quality": op6_quality,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_fingerprints": op10_fingerprints,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_collocations": op12_collocations,
    "op13_dataset_manifest": op13_dataset_manifest,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": lines.ORACLE,
    "op4_url_filter": urls.oracle(),
    "op5_chat_format": chat.ORACLE,
    "op9_jaccard_join": jaccard.ORACLE,
    "op10_fingerprints": merkle.ORACLE,
    "op11_exact_top_k": topk.ORACLE,
    "op12_collocations": phrases.ORACLE,
    "op13_dataset_manifest": manifest.oracle(),
}
