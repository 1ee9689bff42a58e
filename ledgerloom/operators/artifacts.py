"""Artifacts around an edition: blocks from spans, guards, contracts, audits, backfills and a token index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as T

#: What is kept of one edition, and the kind of each.
ARTIFACTS = {"manifest": "manifests", "structured": "structured", "markdown": "markdown", "mentions": "mentions", "semantic": "semantic", "identity": "identity", "audit": "audits", "summary": "summaries"}


def artifact_paths(root: str, document: Column) -> Column:
    """Map of artifact to the folder of its table's partition for a document."""
    pairs = [x for k, v in ARTIFACTS.items() for x in (F.lit(k), F.concat(F.lit(f"{root.rstrip('/')}/{v}/document="), document))]
    return F.create_map(*pairs)


def _fonts(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group the median size and whether a font's name says bold."""
    return rows.groupBy(*by).agg(F.median("size").alias("font_size"), F.bool_or(F.contains(F.lower("font"), F.lit("bold"))).alias("bold"))


def blocks_from_spans(spans: DataFrame) -> DataFrame:
    """doc_id, page, source_order, block_id, text, lines, font_size, bold from spans (doc_id, page, source_order, line, ord, text, size, font).

    Spans of white space count in a line's text only; lines and blocks without other spans are left out.
    """
    block, line = ["doc_id", "page", "source_order"], ["doc_id", "page", "source_order", "line"]
    solid = spans.filter(T.normalize_line(F.coalesce("text", F.lit(""))) != "")
    parts = F.array_sort(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("text"))))
    lines = spans.groupBy(*line).agg(F.array_join(parts["text"], "").alias("text")).join(solid.select(*line).distinct(), line, "left_semi")
    held = F.array_sort(F.collect_list(F.struct("line", "text")))
    out = lines.groupBy(*block).agg(T.join_lines(held["text"]).alias("text"), F.count("*").alias("lines")).filter("text <> ''")
    name = F.format_string("p%04d-b%04d", F.col("page"), F.col("source_order"))
    return out.join(_fonts(solid, block), block).withColumn("block_id", name)


def quarantine(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with text, and those without, which are set aside with a reason."""
    empty = T.normalize_spaces(F.coalesce("text", F.lit(""))) == ""
    return docs.filter(~empty), docs.filter(empty).withColumn("reason", F.when(F.col("text").isNull(), "unreadable").otherwise("no_text"))


def stale(artifacts: DataFrame, tool: str, version: str) -> DataFrame:
    """Artifacts of a tool that another version of it made, or none that is known."""
    return artifacts.filter((F.col("tool") == tool) & ~F.col("tool_version").eqNullSafe(F.lit(version)))


def first_violation(rows: DataFrame, keys: list[str], checks: dict[str, Column], contract: str | None = None) -> DataFrame:
    """keys, path, message (with the contract's name, if given): of each row that breaks a check the first path in order."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(p)) for p, c in sorted(checks.items())]))
    found = rows.select(*keys, F.try_element_at(broken, F.lit(1)).alias("path")).filter("path is not null")
    name = f"Contrato '{contract}' inválido em " if contract else "Contrato inválido em "
    return found.withColumn("message", F.concat(F.lit(name), "path"))


def counts_in_order(rows: DataFrame, kind: str, first_seen: str) -> DataFrame:
    """kind, count, place: most frequent first, of equals the one seen first. The kinds are few; only they are ranked."""
    counts = rows.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("count"), F.min(first_seen).alias("seen"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("count"), "seen"))).drop("seen")


def examples(rows: DataFrame, order: list, most: int = 5) -> DataFrame:
    return rows.orderBy(*order).limit(most)


def audit(blocks: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row: blocks, noise blocks, mentions, pages with mentions (a missing page is one), mentions without a block."""
    base = blocks.agg(F.count("*").alias("blocks"), F.count_if("noise").alias("noise_blocks"))
    page = F.struct("doc_id", F.coalesce("page", F.lit(-1)))
    found = mentions.agg(F.count("*").alias("mentions"), F.count_distinct(page).alias("pages_with_mentions"))
    lost = mentions.join(blocks.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_anti").agg(F.count("*").alias("without_block"))
    one = F.lit(1).alias("one_")
    return base.select("*", one).join(found.select("*", one), "one_").join(lost.select("*", one), "one_").drop("one_")


def counts_of_latest(runs: DataFrame, order: list, tables: dict[str, DataFrame], run: str) -> DataFrame:
    """run, table_name, rows of the latest run's rows in each table, 0 too."""
    last = runs.orderBy(*[F.desc(c) for c in order]).limit(1).select(run)
    out = None
    for name, df in tables.items():
        n = df.groupBy(run).agg(F.count("*").alias("rows"))
        one = last.join(n, run, "left").select(run, F.lit(name).alias("table_name"), F.coalesce("rows", F.lit(0)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def backfill_captures(captures: DataFrame, documents: DataFrame, blobs: DataFrame, policies: DataFrame) -> DataFrame:
    """Captures with their document, their blob and, where source and kind have one, their policy."""
    rows = captures.join(documents, "document").join(blobs, "sha256")
    return rows.join(policies, ["source", "kind"], "left")


def token_index(blocks: DataFrame, language_words: int = 1) -> DataFrame:
    """token, doc_id, occurrences: words without marks and case; words of fewer letters than language_words are left out."""
    words = F.regexp_extract_all(F.lower(T.without_marks(F.col("text"))), F.lit(r"(?U)[\p{L}\p{N}]+"), F.lit(0))
    rows = blocks.select("doc_id", F.explode(words).alias("token")).filter(F.length("token") >= language_words)
    return rows.groupBy("token", "doc_id").agg(F.count("*").alias("occurrences"))


def role_targets(entities: DataFrame, prefix: str = "subject_of:") -> DataFrame:
    """doc_id, target, role: roles that begin with prefix, and the key behind it."""
    return entities.filter(F.col("role").startswith(prefix)).select("doc_id", F.substring("role", F.lit(len(prefix) + 1), F.length("role")).alias("target"), F.lit(prefix.rstrip(":_")).alias("role"))
