"""Contracts of artifacts as predicates on columns: what the first broken one of a row is, is a query.

Each contract maps a path to a predicate that holds for a sound row; a null predicate is broken.
Types and unknown fields are the schema's matter (see STRUCTURED in documents, read with FAILFAST).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.artifacts import first_violation

# fixed values
SHA256, BLOCK_ID, PROCESS_NUMBER = "^[0-9a-f]{64}$", "^p[0-9]{4}-b[0-9]{4}$", "^[0-9]{5}-[0-9]{8}/[0-9]{4}-[0-9]{2}$"
MEDIA_TYPE, ROLES, TEXT_FIELDS = "application/pdf", ("h1", "h2", "h3", "paragraph"), ("text_original", "text_normalized")


def _filled(c: str) -> Column:
    return F.length(c) >= 1


def _least(c: str, n: int) -> Column:
    return F.col(c) >= n


def manifest() -> dict[str, Column]:
    return {
        "document.filename": _filled("filename"), "document.media_type": F.col("media_type") == MEDIA_TYPE, "document.page_count": _least("page_count", 1),
        "document.path": _filled("path"), "document.sha256": F.col("sha256").rlike(SHA256), "document.size_bytes": _least("size_bytes", 1),
    }


def page() -> dict[str, Column]:
    return {"pages.height": F.col("height") > 0, "pages.number": _least("number", 1), "pages.rotation": F.col("rotation").isNotNull(), "pages.width": F.col("width") > 0}


def block() -> dict[str, Column]:
    """Of blocks as they are in a structured document."""
    return {
        "blocks.bbox": (F.size("bbox") == 4) & ~F.exists("bbox", lambda x: x.isNull()), "blocks.bold": F.col("bold").isNotNull(), "blocks.column": _least("column", 0), "blocks.font_size": _least("font_size", 0),
        "blocks.id": F.col("id").rlike(BLOCK_ID), "blocks.markdown_role": F.col("markdown_role").isin(*ROLES), "blocks.order": _least("order", 1), "blocks.page": _least("page", 1),
        "blocks.removed_as_noise": F.col("removed_as_noise").isNotNull(), "blocks.source_order": _least("source_order", 1),
        "blocks.text_normalized": F.col("text_normalized").isNotNull(), "blocks.text_original": F.col("text_original").isNotNull(),
    }


def mention() -> dict[str, Column]:
    return {
        "mentions.block_id": F.col("block_id").rlike(BLOCK_ID), "mentions.block_order": _least("ord", 1), "mentions.end": _least("end", 1), "mentions.page": _least("page", 1),
        "mentions.rule.name": _filled("rule"), "mentions.rule.version": _filled("rule_version"), "mentions.snippet": _filled("snippet"), "mentions.start": _least("start", 0),
        "mentions.value_normalized": F.col("value_normalized").rlike(PROCESS_NUMBER), "mentions.value_original": _filled("value_original"),
    }


CONTRACTS = {"manifest": manifest, "page": page, "block": block, "mention": mention}


def check(rows: DataFrame, contract: str, keys: list[str]) -> DataFrame:
    """keys, path, message of each row that breaks its contract: the first path in order."""
    return first_violation(rows, keys, CONTRACTS[contract](), contract)
