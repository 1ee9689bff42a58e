"""Queries of structured JSON, contracts and bundles, over the lines of the driver's texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import storage
from ledgerloom.functions import text as T
from ledgerloom.operators import ledger
from ledgerloom.queries.text import LINES, table
from ledgerloom.sources import contracts, editions
from ledgerloom.sources import documents as D
from ledgerloom.sources.tablesets import TableSets

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


def _structured(spark, sf_dir):
    """A structured document per text, as JSON: a page per text, a block per line; every seventh line is noise."""
    rows = D.text_blocks(table(spark, sf_dir, "documents"))
    block = F.struct(
        F.col("block_id").alias("id"), "page", F.col("ord").alias("order"), F.col("ord").alias("source_order"), F.lit(0).alias("column"), F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4)]).alias("bbox"),
        F.col("text").alias("text_original"), F.concat(F.lit(" "), "text").alias("text_normalized"), F.lit(10.0).alias("font_size"), F.lit(False).alias("bold"),
        F.when(F.col("ord") % 5 == 0, "h2").alias("markdown_role"), (F.col("ord") % 7 == 0).alias("removed_as_noise"),
    )
    pages = rows.groupBy("doc_id").agg(F.collect_list(block).alias("blocks"))
    page = F.struct(F.lit(1).alias("number"), F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), F.lit(0).alias("rotation"), "blocks")
    source = F.struct(F.concat(F.lit("doc-"), "doc_id").alias("sha256"))
    return pages.select(F.to_json(F.struct(source.alias("source"), F.array(page).alias("pages"))).alias("value"))


@query("structured_blocks", f"with {LINES} select 'doc-' || doc_id as doc_id, 1 as page, cast(ord as int) as ord, block_id, text, case when ord % 5 = 0 then 'h2' else 'paragraph' end as role, ord % 7 = 0 as noise from blocks")
def structured_blocks(spark, sf_dir):
    return D.flatten(D.parse_structured(_structured(spark, sf_dir)))


@query("page_metadata", f"with {LINES} select distinct 'doc-' || doc_id as doc_id, 1 as number, cast(595 as double) as width, cast(842 as double) as height, 0 as rotation from blocks")
def page_metadata(spark, sf_dir):
    return D.page_metadata(D.parse_structured(_structured(spark, sf_dir)))


@query("document_bundles", f"""with {LINES} select doc_id, '{{"blocks":[' || string_agg('{{"ord":' || lpad(cast(ord as varchar), 6, '0') || ',"id":"' || block_id || '"}}', ',' order by ord) || '],"notes":' || case when doc_id % 3 = 0 then '[{{"n":' || max(1) || '}}]' else '[]' end || '}}' as bundle from blocks group by doc_id""".replace("lpad(cast(ord as varchar), 6, '0')", "cast(100000 + ord as varchar)"))
def document_bundles(spark, sf_dir):
    blocks = D.text_blocks(table(spark, sf_dir, "documents")).select("doc_id", (F.col("ord") + 100000).alias("ord"), F.col("block_id").alias("id"))
    notes = blocks.filter("doc_id % 3 = 0").select("doc_id", F.lit(1).alias("n")).distinct()
    return D.bundles({"blocks": blocks, "notes": notes})


@query(
    "contract_violations",
    f"""with {LINES} select doc_id, ord, path, 'Contrato ''block'' inválido em ' || path as message from (select doc_id, cast(ord as int) as ord,
  case when ord % 11 = 0 then 'blocks.bbox' when ord % 5 = 0 then 'blocks.id' when ord % 7 = 0 then 'blocks.markdown_role' when ord % 13 = 0 then 'blocks.text_original' end as path from blocks) where path is not null""",
)
def contract_violations(spark, sf_dir):
    ord_, four = F.col("ord"), F.array(*[F.lit(1.0)] * 4)
    rows = D.text_blocks(table(spark, sf_dir, "documents")).select(
        "doc_id", "ord", "page", ord_.alias("order"), ord_.alias("source_order"), F.lit(0).alias("column"), F.lit(10.0).alias("font_size"), F.lit(False).alias("bold"), F.lit(False).alias("removed_as_noise"),
        F.when(ord_ % 11 == 0, F.array(F.lit(1.0))).otherwise(four).alias("bbox"), F.when(ord_ % 5 != 0, F.lit("p0001-b0001")).otherwise("b1").alias("id"),
        F.when(ord_ % 7 != 0, "h1").otherwise("h9").alias("markdown_role"), F.when(ord_ % 13 != 0, F.col("text")).alias("text_original"), F.col("text").alias("text_normalized"),
    )
    return contracts.check(rows, "block", ["doc_id", "ord"])


@query("utc_stamps", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') as stamp from events")
def utc_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.utc_stamp(F.col("ts")).alias("stamp"))


@query("table_sets", "select 'documents' as table_name, count(*) as rows from documents union all select 'pages', count(*) from pages")
def table_sets(spark, sf_dir):
    """Two tables committed as one set, then a newer write that ended before its commit: readers still have the set."""
    sets = TableSets(spark, storage.new_folder(spark, "sets"))
    documents, pages = table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "pages").select("page_id", "url")
    sets.write("load-1", {"documents": documents, "pages": pages})
    documents.unionByName(documents).write.parquet(f"{sets.root}/load-2.{'0' * 32}/documents")
    return ledger.table_counts(sets.tables())


@query("json_sink", "select doc_id, lang, source, n_chars from documents")
def json_sink(spark, sf_dir):
    """Rows written as JSON lines and read again."""
    folder = storage.new_folder(spark, "json")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    D.write_json(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query("edition_source", ORACLE["structured_blocks"])
def edition_source(spark, sf_dir):
    """Structured documents written as one file each by the data source of editions, and read again as blocks."""
    editions.register(spark)
    folder = storage.new_folder(spark, "editions")
    rows = _structured(spark, sf_dir)
    rows.select(F.get_json_object("value", "$.source.sha256").alias("name"), "value").write.format("editions").mode("append").save(folder)
    return spark.read.format("editions").load(folder)
