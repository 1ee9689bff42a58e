"""Queries of page layout over boxes made from line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import layout, ledger

#: Boxes as one SQL text for Spark and DuckDB: orders of a customer are pages, their items blocks.
BOXES = """
b_a as (select o_custkey as doc_id, o_orderkey, dense_rank() over (partition by o_custkey order by o_orderkey) as page, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int) as q,
  row_number() over (partition by o_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as source_order from {lineitem} join {orders} on l_orderkey = o_orderkey),
boxes as (select doc_id, cast(page as int) as page, cast(source_order as int) as source_order,
  cast(case when l_partkey % 4 = 0 then 40 when l_partkey % 4 = 1 then 320 else 40 end as double) as x0, cast((source_order * 97 + 690) % 780 as double) as y0,
  cast(case when l_partkey % 4 = 0 then 560 when l_partkey % 4 = 1 then 560 else 290 end as double) as x1, cast((source_order * 97 + 690) % 780 + 20 + q as double) as y1,
  case when l_partkey % 5 = 0 then 'Diário ' || cast(l_partkey % 2 as varchar(9)) when l_partkey % 7 = 0 then cast(page as varchar(9)) when l_partkey % 11 = 0 then 'PÁGINA 2 Diário Oficial do Distrito Federal hoje'
    when l_partkey % 13 = 0 then 'SEÇÃO II' else 'Texto corrido do bloco numero ' || cast(l_suppkey as varchar(9)) || ' com mais palavras' end as text,
  cast(case when l_suppkey % 6 = 0 then 16 when l_suppkey % 6 = 1 then 11.5 else 10 end as double) as font_size, l_suppkey % 3 = 1 as bold from b_a),
sheets as (select distinct doc_id, page, cast(600 as double) as width, cast(800 as double) as height from boxes)
"""

ENRICHED = r"""
m_a as (select doc_id, greatest(2, cast(round_even(count(*) * 0.30, 0) as bigint)) as least from sheets group by 1),
m_b as (select distinct b.doc_id, b.page, lower(text) as folded from boxes b join sheets s on b.doc_id = s.doc_id and b.page = s.page where y1 < height * 0.12 or y0 > height * (1 - 0.12)),
margins as (select m_b.doc_id, folded, count(*) as pages from m_b join m_a on m_b.doc_id = m_a.doc_id group by m_b.doc_id, folded, least having count(*) >= least),
sizes as (select doc_id, coalesce(median(case when length(text) >= 40 then font_size end), 10.0) as body_size from boxes group by 1),
e as (select b.*, width, body_size, case when margins.folded is not null then 'repeated_margin' when regexp_matches(text, '(?i)^(?:pagina\s+)?\d+$') then 'page_number' when regexp_matches(text, '(?i)^P[AÁ]GINA\s+\d+\s+Di[aá]rio Oficial do Distrito Federal($|[^\pL\pN_])') then 'running_header' end as noise_reason,
  case when regexp_matches(text, '(?i)^SE[CÇ][AÃ]O\s+[IVXLCDM]+$') then 'h1' when font_size >= body_size * 1.45 then 'h2' when bold and font_size >= body_size * 1.08 and length(text) <= 180 then 'h3' else 'paragraph' end as role,
  case when x1 - x0 >= width * 0.62 then 0 when (x0 + x1) / 2 < width / 2 then 1 else 2 end as col
  from boxes b join sheets s on b.doc_id = s.doc_id and b.page = s.page join sizes z on b.doc_id = z.doc_id left join margins on b.doc_id = margins.doc_id and lower(b.text) = margins.folded),
k as (select e.*, (select count(*) from e w where w.doc_id = e.doc_id and w.page = e.page and w.col = 0 and w.y0 < e.y1) as above,
  (select count(*) from e w where w.doc_id = e.doc_id and w.page = e.page and w.col = 0 and (w.y0 < e.y0 or (w.y0 = e.y0 and w.source_order < e.source_order))) as wide_before,
  exists(select 1 from e w where w.doc_id = e.doc_id and w.page = e.page and w.col <> 0) as mixed from e),
ordered as (select *, row_number() over (partition by doc_id, page order by case when not mixed then 0 when col = 0 then wide_before else above end, case when mixed and col = 0 then 1 else 0 end, col,
  case when mixed and col = 0 then 0 else y0 end, case when mixed and col = 0 then 0 else x0 end, source_order) as ord from k)
"""

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders")}
    return tuple(spark.sql(f"with {BOXES} select * from {t}", **frames) for t in ("boxes", "sheets"))


def query(name: str, sql: str):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: function(*tables(spark, sf_dir))
        ORACLE[name] = f"with {BOXES.format(lineitem='lineitem', orders='orders')}, {ENRICHED} {sql}"
        return function

    return add


@query("repeated_margins", "select * from margins")
def _(boxes, sheets):
    return layout.repeated_margins(boxes, sheets)


@query("body_sizes", "select * from sizes")
def _(boxes, sheets):
    return layout.body_size(boxes)


@query("block_layout", "select doc_id, page, source_order, noise_reason, noise_reason is not null as noise, role, col as \"column\", cast(ord as int) as ord from ordered")
def _(boxes, sheets):
    return layout.enrich(boxes, sheets).select("doc_id", "page", "source_order", "noise_reason", "noise", "role", "column", "ord")


@query("noise_counts", "select noise_reason, count(*) as blocks, count(distinct doc_id) as documents from ordered group by 1")
def _(boxes, sheets):
    return layout.enrich(boxes, sheets).groupBy("noise_reason").agg(F.count("*").alias("blocks"), F.countDistinct("doc_id").alias("documents"))


@query("rounded_boxes", "select doc_id, page, source_order, x0, round(y1 / 8 + 0.001, 2) as y1 from boxes")
def _(boxes, sheets):
    box = layout.rounded_box(F.array("x0", F.col("y1") / 8 + 0.001))
    return boxes.select("doc_id", "page", "source_order", box[0].alias("x0"), box[1].alias("y1"))


@query("boxes_of_four", "select 'bbox_has_four_values' as constraint_name, count(*) filter (where source_order % 3 = 0) as violations from boxes")
def _(boxes, sheets):
    box = F.when(F.col("source_order") % 3 == 0, F.array("x0", "y0", "x1")).otherwise(F.array("x0", "y0", "x1", "y1"))
    return ledger.violations(boxes.withColumn("bbox", box), {"bbox_has_four_values": ledger.is_box("bbox")})
