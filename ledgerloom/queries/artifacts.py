"""Queries of artifacts, over line items, events, documents and the ledger's shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import artifacts as A
from ledgerloom.queries.text import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


SPANS = """select l_orderkey as doc_id, cast(l_suppkey % 2 + 1 as int) as page, cast(l_partkey % 3 + 1 as int) as source_order, cast(l_linenumber as int) as line, cast(l_quantity as int) * 1000000 + l_partkey * 10 as ord,
  case when l_partkey % 6 = 0 then '  ' when l_partkey % 5 = 0 then 'meia-' when l_partkey % 7 = 0 then ' noite ' else 'P' || cast(l_partkey as varchar(20)) end as text, cast(8 + l_suppkey % 5 as double) as size, case when l_partkey % 4 = 0 then 'Arial-Bold' else 'Arial' end as font from {lineitem}"""


@query(
    "blocks_from_spans",
    f"""with s as ({SPANS.format(lineitem='lineitem')}), solid as (select * from s where trim(text) <> ''), l as (select doc_id, page, source_order, line, trim(regexp_replace(string_agg(text, '' order by ord, text), ' +', ' ', 'g')) as text from s group by all having bool_or(trim(text) <> '')),
o as (select *, row_number() over (partition by doc_id, page, source_order order by line) as n, lead(text) over (partition by doc_id, page, source_order order by line) as nxt from l),
b as (select doc_id, page, source_order, string_agg(case when nxt is null then text when ends_with(text, '-') and regexp_matches(nxt, '^[a-z]') then text[1:length(text) - 1] else text || ' ' end, '' order by n) as text, count(*) as lines from o group by all),
f as (select doc_id, page, source_order, median(size) as font_size, bool_or(contains(lower(font), 'bold')) as bold from solid group by all)
select doc_id, page, source_order, text, lines, font_size, bold, printf('p%04d-b%04d', page, source_order) as block_id from b join f using (doc_id, page, source_order)""",
)
def blocks_from_spans(spark, sf_dir):
    return A.blocks_from_spans(spark.sql(SPANS, lineitem=table(spark, sf_dir, "lineitem")))


@query("quarantined", "select event_id as doc_id, case when event_id % 7 = 0 then 'unreadable' else 'no_text' end as reason from events where event_id % 7 = 0 or event_id % 5 = 0")
def quarantined(spark, sf_dir):
    k = F.col("event_id")
    docs = table(spark, sf_dir, "events").select(k.alias("doc_id"), F.when(k % 7 != 0, F.when(k % 5 == 0, " \t ").otherwise("x")).alias("text"))
    return A.quarantine(docs)[1].drop("text")


@query("stale_artifacts", "select o_orderkey from orders where o_orderstatus = 'F' and (o_orderpriority = '3-MEDIUM') is not true")
def stale_artifacts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("tool"), F.col("o_orderpriority").alias("tool_version"))
    return A.stale(rows, "F", "3-MEDIUM").select("o_orderkey")


@query("first_violations", "select doc_id, case when lang <> 'en' then 'a.lang' when n_chars < 1000 then 'b.size' else 'c.source' end as path, 'Contrato inválido em ' || case when lang <> 'en' then 'a.lang' when n_chars < 1000 then 'b.size' else 'c.source' end as message from documents where lang <> 'en' or n_chars < 1000 or source = 'src3'")
def first_violations(spark, sf_dir):
    checks = {"c.source": F.col("source") != "src3", "a.lang": F.col("lang") == "en", "b.size": F.col("n_chars") >= 1000}
    return A.first_violation(table(spark, sf_dir, "documents"), ["doc_id"], checks)


@query("counts_in_order", "select kind, count, row_number() over (order by count desc, seen) as place from (select event_type as kind, count(*) as count, min(event_id) as seen from events group by 1)")
def counts_in_order(spark, sf_dir):
    return A.counts_in_order(table(spark, sf_dir, "events"), "event_type", "event_id").withColumn("place", F.col("place").cast("long"))


@query("first_examples", "select event_id, user_id from events order by ts, event_id limit 5")
def first_examples(spark, sf_dir):
    return A.examples(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["ts", "event_id"]).drop("ts")


@query("audit_counts", "with m as (select l_orderkey as doc_id, case when l_linenumber = 3 then null else l_linenumber end as page, l_partkey as block_id from lineitem), b as (select distinct l_orderkey as doc_id, l_partkey as block_id, l_partkey % 10 = 0 as noise from lineitem where l_partkey % 9 > 0) select (select count(*) from b) as blocks, (select count(*) from b where noise) as noise_blocks, (select count(*) from m) as mentions, (select count(distinct doc_id || ':' || coalesce(page, -1)) from m) as pages_with_mentions, (select count(*) from m anti join b using (doc_id, block_id)) as without_block")
def audit_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    mentions = rows.select(F.col("l_orderkey").alias("doc_id"), F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("page"), F.col("l_partkey").alias("block_id"))
    blocks = rows.filter("l_partkey % 9 > 0").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("block_id"), (F.col("l_partkey") % 10 == 0).alias("noise")).distinct()
    return A.audit(blocks, mentions)


@query("counts_of_latest_run", "with l as (select o_orderkey as run from orders order by o_orderdate desc, o_orderkey desc limit 1) select run, 'items' as table_name, (select count(*) from lineitem where l_orderkey = run) as rows from l union all select run, 'customers', (select count(*) from customer where c_custkey = run) from l")
def counts_of_latest_run(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), "o_orderdate")
    tables = {"items": table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "run"), "customers": table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "run")}
    return A.counts_of_latest(runs, ["o_orderdate", "run"], tables, "run")


@query("backfill_captures", "select o_orderkey, c_name, n_name as policy from orders join customer on o_custkey = c_custkey join part on p_partkey = o_orderkey % 500 left join nation on n_nationkey = c_nationkey and n_regionkey = o_orderkey % 5")
def backfill_captures(spark, sf_dir):
    captures = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("document"), (F.col("o_orderkey") % 500).alias("sha256"), (F.col("o_orderkey") % 5).cast("int").alias("kind"))
    documents = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document"), "c_name", F.col("c_nationkey").alias("source"))
    blobs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sha256"))
    policies = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"), F.col("n_regionkey").alias("kind"), F.col("n_name").alias("policy"))
    return A.backfill_captures(captures, documents, blobs, policies).select("o_orderkey", "c_name", "policy")


@query("token_index", "select token, doc_id, count(*) as occurrences from (select doc_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[\\pL\\pN]+')) as token from documents) group by 1, 2")
def token_index(spark, sf_dir):
    return A.token_index(table(spark, sf_dir, "documents"))


@query("role_targets", "select event_id as doc_id, 'action-' || user_id as target, 'subject_of' as role from events where event_type <> 'click'")
def role_targets(spark, sf_dir):
    role = F.concat(F.when(F.col("event_type") != "click", "subject_of:action-").otherwise("other:"), F.col("user_id").cast("string"))
    return A.role_targets(table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), role.alias("role")))


@query("artifact_folders", "select doc_id, '/x/manifests/document=' || doc_id as manifest, '/x/identity/document=' || doc_id as identity from documents")
def artifact_folders(spark, sf_dir):
    paths = A.artifact_paths("/x/", F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", paths["manifest"].alias("manifest"), paths["identity"].alias("identity"))
