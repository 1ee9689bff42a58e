"""Sources and sinks: files, structured JSON, and blocks from plain texts and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ledgerloom.functions import text as T

LINE = "struct<order:int,bbox:array<double>,text_original:string,text_normalized:string,font_size:double,bold:boolean>"
BLOCK = (
    "struct<id:string,page:int,order:int,source_order:int,column:int,bbox:array<double>,text_original:string,text_normalized:string,"
    f"font_size:double,bold:boolean,markdown_role:string,removed_as_noise:boolean,noise_reason:string,lines:array<{LINE}>>"
)
#: A structured document: one JSON object per file.
STRUCTURED = (
    "schema_version string, created_at string, source struct<path:string,filename:string,sha256:string,page_count:int>, "
    f"processing struct<body_font_size:double>, pages array<struct<number:int,width:double,height:double,rotation:int,blocks:array<{BLOCK}>>>"
)


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """Structured documents; a file that doesn't fit the schema fails the read."""
    return spark.read.schema(STRUCTURED).option("multiLine", True).option("mode", "FAILFAST").json(path)


def parse_structured(texts: DataFrame, column: str = "value") -> DataFrame:
    """Structured documents from a column of JSON texts; one that doesn't fit the schema fails the query."""
    parsed = F.from_json(column, T_.StructType.fromDDL(STRUCTURED), {"mode": "FAILFAST"})
    return texts.select(parsed.alias("s")).select("s.*")


def flatten(structured: DataFrame) -> DataFrame:
    """doc_id (the source's hash), page, ord, block_id, text, role, noise of every block."""
    pages = structured.select(F.col("source.sha256").alias("doc_id"), F.explode("pages").alias("p"))
    rows = pages.select("doc_id", F.col("p.number").alias("page"), F.explode("p.blocks").alias("b"))
    return rows.select(
        "doc_id", "page", F.col("b.order").alias("ord"), F.col("b.id").alias("block_id"), T.strip(F.coalesce("b.text_normalized", F.lit(""))).alias("text"),
        F.coalesce("b.markdown_role", F.lit("paragraph")).alias("role"), F.coalesce("b.removed_as_noise", F.lit(False)).alias("noise"),
    )


def page_metadata(structured: DataFrame) -> DataFrame:
    """Every page's fields but its blocks."""
    return structured.select(F.col("source.sha256").alias("doc_id"), F.explode("pages").alias("p")).select("doc_id", F.col("p").dropFields("blocks").alias("p")).select("doc_id", "p.*")


def manifests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, filename, size_bytes, modified_at, sha256, media_type of files; only what the listing and the hash need is kept."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(F.lower(name).endswith(".pdf"), "application/pdf").when(F.lower(name).endswith(".json"), "application/json").otherwise("application/octet-stream")
    return files.select("path", name.alias("filename"), F.col("length").alias("size_bytes"), F.date_trunc("second", "modificationTime").alias("modified_at"), F.sha2("content", 256).alias("sha256"), kind.alias("media_type"))


def write_json(rows: DataFrame, path: str, mode: str = "error") -> None:
    rows.write.mode(mode).json(path)


def write_pretty(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Each row as indented JSON, ended by a newline: for artifacts that people read."""
    rows.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def bundles(parts: dict[str, DataFrame], key: str = "doc_id") -> DataFrame:
    """key, bundle: one compact JSON object per document, with an array per part; parts are grouped apart and then met."""
    out = None
    for name, rows in parts.items():
        held = F.array_sort(F.collect_list(F.to_json(F.struct(*[c for c in rows.columns if c != key]))))
        side = rows.groupBy(key).agg(F.concat(F.lit("["), F.array_join(held, ","), F.lit("]")).alias(name))
        out = side if out is None else out.join(side, key, "full")
    fields = [F.concat(F.lit(f'"{name}":'), F.coalesce(name, F.lit("[]"))) for name in parts]
    return out.select(key, F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("bundle"))


def write_bundle(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Each row as one line of compact JSON text."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode(mode).text(path)


def text_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, page (1), ord, block_id, text, role, noise: every line of a text that isn't blank."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    text = T.normalize_line(F.col("line"))
    rows = lines.select("doc_id", F.lit(1).alias("page"), (F.col("pos") + 1).alias("ord"), text.alias("text")).filter("text <> ''")
    return rows.select("doc_id", "page", "ord", F.concat(F.lit("p0001-b"), F.lpad(F.col("ord").cast("string"), 4, "0")).alias("block_id"), "text", F.lit("paragraph").alias("role"), F.lit(False).alias("noise"))


def html_blocks(pages: DataFrame) -> DataFrame:
    """page_id, ord, tag, text of headings, paragraphs and list items of web pages, tags removed."""
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", "")
    found = F.regexp_extract_all(body, F.lit(r"(?is)<(?:h[1-6]|p|li)\b[^>]*>.*?</(?:h[1-6]|p|li)>"), F.lit(0))
    rows = pages.select("page_id", F.posexplode(found).alias("pos", "part"))
    text = T.normalize_spaces(F.regexp_replace("part", r"(?s)<[^>]*>", " "))
    return rows.select("page_id", (F.col("pos") + 1).alias("ord"), F.lower(F.regexp_extract("part", r"^<(\w+)", 1)).alias("tag"), text.alias("text")).filter("text <> ''")
