"""Queries of the ledger, of constraints and of annotation rules, over events, orders and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import annotation, ledger
from ledgerloom.plans import edition
from ledgerloom.queries.text import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("upsert_latest", "select user_id, event_type, event_id, ts from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id % 2 desc, event_id desc) = 1")
def upsert_latest(spark, sf_dir):
    rows = _events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    return ledger.upsert(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), ["user_id", "event_type"], ["ts", F.col("event_id") % 2, "event_id"])


@query("replace_by_run", "select o_custkey as run, o_orderkey, o_orderstatus as status from orders where o_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT') union all select o_custkey, o_orderkey, 'new' from orders where o_orderpriority = '1-URGENT'")
def replace_by_run(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    base = orders.select(F.col("o_custkey").alias("run"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    new = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("run"), "o_orderkey", F.lit("new").alias("status"))
    return ledger.replace_by_run(base, new, "run")


@query("insert_missing", "select c_nationkey as k, 'old' as origin from customer where c_nationkey < 9 group by 1 union all select s_nationkey, 'new' from supplier where s_nationkey not in (select c_nationkey from customer where c_nationkey < 9) group by 1")
def insert_missing(spark, sf_dir):
    base = table(spark, sf_dir, "customer").filter("c_nationkey < 9").select(F.col("c_nationkey").alias("k"), F.lit("old").alias("origin")).distinct()
    return ledger.insert_missing(base, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("new").alias("origin")), ["k"])


@query("latest_run", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def latest_run(spark, sf_dir):
    return ledger.latest_run(_events(spark, sf_dir).select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


NAMES = ("nation", "region", "customer", "supplier", "orders", "events")


@query("table_counts", " union all ".join(f"select '{n}' as table_name, count(*) as rows from {n}" for n in NAMES))
def table_counts(spark, sf_dir):
    return ledger.table_counts({n: table(spark, sf_dir, n) for n in NAMES})


RUNS = "runs as (select 'run:' || event_id as run_key, 'a' || event_id as output, 'a' || cast(floor(event_id / 3) as bigint) as input, event_id from events where event_id > 0)"


def _runs(spark, sf_dir) -> DataFrame:
    rows = _events(spark, sf_dir).filter("event_id > 0")
    name = lambda c: F.concat(F.lit("a"), c.cast("string"))
    return rows.select(F.concat(F.lit("run:"), F.col("event_id").cast("string")).alias("run_key"), F.array(name(F.floor(F.col("event_id") / 3))).alias("inputs"), F.array(name(F.col("event_id"))).alias("outputs"))


@query("lineage_edges", f"with {RUNS} select run_key, input as artifact, 'input' as direction from runs union all select run_key, output, 'output' from runs")
def lineage_edges(spark, sf_dir):
    return ledger.lineage_edges(_runs(spark, sf_dir))


@query("lineage_ancestry", f"with recursive {RUNS}, up as (select output as artifact, input as ancestor, 1 as depth from runs union all select up.artifact, runs.input, depth + 1 from up join runs on runs.output = up.ancestor) select artifact, ancestor, min(depth) as depth from up group by 1, 2")
def lineage_ancestry(spark, sf_dir):
    return ledger.ancestry(ledger.lineage_edges(_runs(spark, sf_dir)))


@query("lineage_guard", "select l_orderkey as mention, count(*) as rows from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey where case when p_size % 5 = 0 then null else p_size % 4 end is distinct from case when s_nationkey % 5 = 0 then null else s_nationkey % 4 end group by 1")
def lineage_guard(spark, sf_dir):
    part = lambda c: F.when(F.col(c) % 5 != 0, F.col(c) % 4)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("mention"), F.col("l_partkey").alias("block_id"), F.col("l_suppkey").alias("run_key"))
    blocks = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("block_id"), part("p_size").alias("capture"))
    runs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("run_key"), part("s_nationkey").alias("capture"))
    return ledger.lineage_violations(rows, blocks, runs).groupBy("mention").agg(F.count("*").alias("rows"))


@query(
    "constraint_violations",
    "select unnest(['hash', 'positive_size', 'span', 'page_range', 'language', 'interval']) as constraint_name, unnest([count(*) filter (where doc_id % 10 = 0), count(*) filter (where n_chars <= 500), count(*) filter (where doc_id % 7 >= n_chars % 9), count(*) filter (where n_chars % 4 < 1 or n_chars % 3 < n_chars % 4), count(*) filter (where lang not in ('en', 'fr')), count(*) filter (where doc_id % 2 = 0 and n_chars <= doc_id)]) as violations from documents",
)
def constraint_violations(spark, sf_dir):
    d, n = F.col("doc_id"), F.col("n_chars")
    rows = table(spark, sf_dir, "documents").select("*", F.when(d % 10 == 0, F.upper(F.sha2("text", 256))).otherwise(F.sha2("text", 256)).alias("sha"), (d % 7).alias("start"), (n % 9).alias("end"), (n % 4).alias("start_page"), (n % 3).alias("end_page"), F.when(d % 2 == 0, n).alias("until"))
    rows = rows.withColumn("sha", F.when(d % 10 == 0, F.concat(F.lit("X"), F.substring("sha", 2, 63))).otherwise(F.col("sha")))
    checks = {"hash": ledger.is_sha256("sha"), "positive_size": n > 500, "span": ledger.is_span(), "page_range": ledger.is_page_range(), "language": F.col("lang").isin("en", "fr"), "interval": ledger.is_interval("doc_id", "until")}
    return ledger.violations(rows, checks)


@query("repeated_keys", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def repeated_keys(spark, sf_dir):
    return ledger.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dangling_rows", "select doc_id, count(*) as rows from (select doc_id from labels union all select event_id from events) x where doc_id not in (select doc_id from documents where doc_id % 3 > 0) group by 1")
def dangling_rows(spark, sf_dir):
    child = table(spark, sf_dir, "labels").select("doc_id").unionByName(_events(spark, sf_dir).select(F.col("event_id").alias("doc_id")))
    return ledger.dangling(child, table(spark, sf_dir, "documents").filter("doc_id % 3 > 0"), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("rows"))


@query("unlike_rows", "select side, l_suppkey, count(*) as rows from (select 'left' as side, l_suppkey from (select l_suppkey, l_linenumber from lineitem where l_returnflag = 'A' except all select l_suppkey, l_linenumber from lineitem where l_returnflag = 'R') union all select 'right', l_suppkey from (select l_suppkey, l_linenumber from lineitem where l_returnflag = 'R' except all select l_suppkey, l_linenumber from lineitem where l_returnflag = 'A')) group by 1, 2")
def unlike_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    side = lambda f: rows.filter(F.col("l_returnflag") == f).select("l_suppkey", "l_linenumber")
    return ledger.unlike(side("A"), side("R")).groupBy("side", "l_suppkey").agg(F.count("*").alias("rows"))


@query("baseline_divergence", "select n_regionkey, name, actual, expected from (select n_regionkey, 'nations' as name, count(*) as actual, case when n_regionkey = 1 then count(*) + 1 else count(*) end as expected from nation group by 1) where actual is distinct from expected union all select n_regionkey, 'longest', max(length(n_name)), 7 from nation group by 1 having max(length(n_name)) <> 7")
def baseline_divergence(spark, sf_dir):
    found = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("nations"), F.max(F.length("n_name")).cast("long").alias("longest"))
    expected = found.select("n_regionkey", F.when(F.col("n_regionkey") == 1, F.col("nations") + 1).otherwise(F.col("nations")).alias("nations"), F.lit(7).cast("long").alias("longest"))
    return edition.against_baseline(found, expected, ["n_regionkey"])


@query("agreement", "with a as (select doc_id from labels where quality = 1), b as (select doc_id from documents where n_chars > 1000) select lang, count(*) filter (where a.doc_id is not null and b.doc_id is not null) as true_positive, count(*) filter (where a.doc_id is null and b.doc_id is not null) as false_positive, count(*) filter (where a.doc_id is not null and b.doc_id is null) as false_negative from documents d left join a on a.doc_id = d.doc_id left join b on b.doc_id = d.doc_id where a.doc_id is not null or b.doc_id is not null group by 1")
def agreement(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    good = table(spark, sf_dir, "labels").filter("quality = 1").join(docs, "doc_id").select("doc_id", "lang")
    return annotation.agreement(good, docs.filter("n_chars > 1000").select("doc_id", "lang"), ["doc_id", "lang"], ["lang"])


def _batches(spark, sf_dir) -> DataFrame:
    """One batch per customer, one record per order; fields cycle by key so that every rule breaks somewhere."""
    k = F.col("o_orderkey")
    pick = lambda values, step=1: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(k / step) % len(values) + 1).cast("int"))
    kind = pick(KINDS)
    evidence = F.array(F.struct(F.when(k % 13 == 0, "other").otherwise("doc").alias("document_sha256"), (k % 4 + 1).cast("int").alias("page"), F.when(k % 5 > 0, (k % 9).cast("int")).alias("start"), F.when(k % 6 > 0, (k % 11).cast("int")).alias("end")))
    words = lambda n, s: F.slice(F.array(*[F.lit(s)] * 3), F.lit(1), n.cast("int"))
    record = F.struct(
        (k % 500).cast("string").alias("id"), kind.alias("annotation_type"), F.when(k % 3 == 0, "identity_resolution").otherwise("reference").alias("task_type"), pick(JUDGMENTS, 4).alias("judgment"),
        F.when(k % 2 == 0, "t").alias("target"), F.when(k % 7 == 0, None).when(k % 7 == 1, "").otherwise("why").alias("rationale"), words(k % 3, "boundary_error").alias("error_categories"), words(k % 4, "f").alias("fragment_ids"), evidence.alias("evidence"),
    )
    c = F.col("o_custkey")
    modes = F.element_at(F.array(*[F.lit(m) for m in MODES]), (c % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(record.cast(annotation.RECORD)).alias("records"))
    return rows.select(c.cast("string").alias("batch_id"), modes.alias("mode"), words(c % 3, "auto").alias("automatic_artifacts"), F.lit("doc").alias("document_sha256"), F.lit(3).alias("page_count"), F.when(c % 5 == 0, F.array(F.lit(1), F.lit(4))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("pages"), "records")


KINDS = ("observation", "evaluation", "identity_decision", "adjudication")
JUDGMENTS = ("PRESENT", "CONFIRMED", "REJECTED", "MISSING", "AMBIGUOUS", "SAME_ENTITY")
MODES = ("blind_primary", "independent_second", "assisted_review", "adjudication")
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


@query(
    "annotation_violations",
    f"""with b as (select distinct o_custkey as c from orders), m as (select c, {_LIST(MODES)}[c % 4 + 1] as mode, case when c % 5 = 0 then [1, 4] else [1, 2, 3] end as pages from b),
r as (select o_custkey as c, o_orderkey as k, cast(o_orderkey % 500 as varchar) as id, {_LIST(KINDS)}[o_orderkey % 4 + 1] as kind, {_LIST(JUDGMENTS)}[cast(floor(o_orderkey / 4) as bigint) % 6 + 1] as j, mode, pages from orders join m on o_custkey = c),
v as (
  select c, null as id, 'scope_beyond_document' as rule from m where c % 5 = 0
  union all select c, null, 'automatic_input' from m where c % 4 < 2 and c % 3 > 0
  union all select c, id, 'independent_only_observes' from r where c % 4 < 2 and (kind <> 'observation' or k % 2 = 0)
  union all select c, id, 'assisted_evaluates' from r where c % 4 = 2 and kind not in ('evaluation', 'identity_decision')
  union all select c, id, 'adjudication_only' from r where c % 4 = 3 and kind <> 'adjudication'
  union all select c, id, 'judgment_of_type' from r where not case kind when 'observation' then j in ('PRESENT', 'AMBIGUOUS') when 'evaluation' then j in ('CONFIRMED', 'REJECTED', 'MISSING', 'AMBIGUOUS') when 'identity_decision' then j = 'SAME_ENTITY' else j <> 'PRESENT' end
  union all select c, id, 'target_missing' from r where j in ('CONFIRMED', 'REJECTED') and k % 2 = 1
  union all select c, id, 'error_category_missing' from r where j in ('REJECTED', 'MISSING') and k % 3 = 0
  union all select c, id, 'identity_incomplete' from r where kind = 'identity_decision' and (k % 3 <> 0 or k % 4 < 2)
  union all select c, id, 'rationale_missing' from r where j in ('REJECTED', 'AMBIGUOUS', 'SAME_ENTITY') and k % 7 < 2
  union all select c, id, 'repeated_id' from (select c, id from r group by 1, 2 having count(*) > 1)
  union all select c, id, 'evidence_of_other_document' from r where k % 13 = 0
  union all select c, id, 'evidence_out_of_scope' from r where not list_contains(pages, k % 4 + 1)
  union all select c, id, 'evidence_span' from r where (k % 5 = 0) <> (k % 6 = 0) or (k % 5 > 0 and k % 6 > 0 and k % 11 <= k % 9))
select cast(c as varchar) as batch_id, id as record_id, rule, count(*) as times from v group by 1, 2, 3""",
)
def annotation_violations(spark, sf_dir):
    return annotation.violations(_batches(spark, sf_dir))


