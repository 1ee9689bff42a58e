"""A corpus pipeline of five stages; part of the subpackage llm.

documents -> without those that the quality classifier rejects -> without repeated lines, and without
documents that consist of them -> one document of each group of near copies -> without documents
that hold benchmark items -> tokens.
Every stage works on all rows that the one before kept, written as Parquet and read again, and
returns the columns of documents; the last returns what encoding gives.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontam, jaccard, lines, quality
from ledgerloom.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the classifier that labels.quality trains."""
    found = quality.classify(docs, table(spark, sf_dir, "labels"))
    return found.filter("quality_score >= 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier run; n_chars follows the text.

    A document that had words and has none left goes: all of it was said before. One without words stays.
    """
    found = lines.dedup_lines(docs, lines.WINDOW, lines.LONG_WORDS).withColumnRenamed("text", "left_over")
    blank = lambda c: ~F.coalesce(c.cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    found = found.filter(blank(F.col("row.text")) | ~blank(F.col("left_over")))
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    n_chars = F.coalesce(F.length("left_over"), F.lit(0)).cast("long").alias("n_chars")
    return found.select(*columns, F.col("left_over").alias("text"), n_chars).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies, and all documents in no group, among them those without words."""
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digest(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", keep_one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("tokens", tokens),
]

#: SQL can't express a trained classifier or the merges of a vocabulary; tests/llm compares the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
