"""Evidence mentions: rules over blocks, each match with its exact span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import Rule, extract, let

PROCESS_RULES = [Rule("processo_sei", V.PATTERNS["processo_sei"])]


def visible(blocks: DataFrame, include_noise: bool = False) -> DataFrame:
    """Blocks with text, without noise unless asked for; the normalized text first, else the original."""
    text = F.coalesce(F.nullif("text", F.lit("")), F.nullif("text_original", F.lit("")), F.lit("")) if "text_original" in blocks.columns else F.coalesce("text", F.lit(""))
    return blocks.withColumn("text", text).filter((F.lit(include_noise) | ~F.coalesce("noise", F.lit(False))) & (F.col("text") != ""))


def mentions(blocks: DataFrame, rules: list[Rule] = PROCESS_RULES, include_noise: bool = False, normalize=T.normalize_process, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, block_id, page, ord, rule, rule_version, start, end, value_original, value_normalized, snippet, and the columns carry of their block."""
    found = extract(visible(blocks, include_noise), "text", rules)
    return found.select(
        "doc_id", "block_id", "page", "ord", "rule", "rule_version", "start", "end",
        F.col("value").alias("value_original"),
        let(F.col("value"), normalize).alias("value_normalized"),
        let(F.col("text"), lambda text: T.snippet(text, F.col("start"), F.col("end"))).alias("snippet"),
        *carry,
    )


def counts_by_rule(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(F.count("*").alias("total"), F.countDistinct("value_normalized").alias("distinct_values"))


def orphans(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """Mentions whose block isn't there."""
    return found.join(blocks.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_anti")


def with_block(found: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
    """Mentions with columns of their block; a mention without one fails the query."""
    side = blocks.select("doc_id", "block_id", *columns, F.lit(True).alias("there_"))
    rows = found.join(side, ["doc_id", "block_id"], "left")
    return rows.filter(F.coalesce("there_", F.raise_error(F.concat(F.lit("no block "), "block_id")).cast("boolean"))).drop("there_")


def in_order(order: list[Column | str], prefix: str, digits: int, per: str = "doc_id") -> Column:
    """Numbered ids such as entity-000001, counted inside each document."""
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return F.format_string(f"{prefix}-%0{digits}d", number)
