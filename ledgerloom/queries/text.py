"""Queries of scalar functions, sources and generic rules over the driver's texts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.spans import Rule
from ledgerloom.operators import mentions, views
from ledgerloom.plans.gazette import _check
from ledgerloom.sources import documents as D

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


LINES = "l as (select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as ord from documents), blocks as (select doc_id, ord, 'p0001-b' || lpad(cast(ord as varchar), 4, '0') as block_id, trim(regexp_replace(replace(raw, chr(160), ' '), '[ \\t]+', ' ', 'g')) as text from l where trim(regexp_replace(replace(raw, chr(160), ' '), '[ \\t]+', ' ', 'g')) <> '')"
RULES = {"email": r"[A-Za-z0-9._]+@[A-Za-z0-9-]+\.[a-z]{2,}", "ipv4": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "licence": r"(?i)\blicen[sc]ed?\b"}


@query("text_blocks", f"with {LINES} select doc_id, 1 as page, cast(ord as int) as ord, block_id, text, 'paragraph' as role, false as noise from blocks")
def text_blocks(spark, sf_dir):
    return D.text_blocks(table(spark, sf_dir, "documents"))


@query(
    "generic_mentions",
    f"with {LINES}, "
    + ", ".join(f"m_{k} as (select *, '{k}' as rule, regexp_extract_all(text, '{p}') as m, string_split_regex(text, '{p}') as g from blocks where regexp_matches(text, '{p}'))" for k, p in RULES.items())
    + ", u as (select *, unnest(range(1, len(m) + 1)) as i from ("
    + " union all ".join(f"select * from m_{k}" for k in RULES)
    + ")) select doc_id, block_id, rule, cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as int) as start, m[i] as value_original from u",
)
def generic_mentions(spark, sf_dir):
    rules = [Rule(k, p) for k, p in RULES.items()]
    found = mentions.mentions(D.text_blocks(table(spark, sf_dir, "documents")), rules, normalize=T.normalize_spaces)
    return found.select("doc_id", "block_id", "rule", "start", "value_original")


@query("repeated_lines", f"with {LINES} select text, count(*) as occurrences, count(distinct doc_id) as documents from blocks group by 1 having count(*) >= 5")
def repeated_lines(spark, sf_dir):
    rows = D.text_blocks(table(spark, sf_dir, "documents")).groupBy("text")
    return rows.agg(F.count("*").alias("occurrences"), F.countDistinct("doc_id").alias("documents")).filter("occurrences >= 5")


@query(
    "html_blocks",
    r"""with b as (select page_id, regexp_extract_all(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>', '', 'g'), '(?is)<(?:h[1-6]|p|li)\b[^>]*>.*?</(?:h[1-6]|p|li)>') as m from pages),
u as (select page_id, unnest(m) as part, generate_subscripts(m, 1) as ord from b)
select page_id, cast(ord as int) as ord, lower(regexp_extract(part, '^<(\w+)', 1)) as tag, trim(regexp_replace(regexp_replace(part, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as text from u
where trim(regexp_replace(regexp_replace(part, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) <> ''""",
)
def html_blocks(spark, sf_dir):
    return D.html_blocks(table(spark, sf_dir, "pages"))


@query("document_hashes", "select doc_id, sha256(text) as sha256, 'extraction:' || sha256(text) as run_key, 'conversion:' || sha256(text) || ':' || sha256(lang) as conversion_key, case when source = 'src1' then 'repo:///data/' || doc_id else 'urn:sha256:' || sha256(text) end as uri from documents")
def document_hashes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("sha256", F.sha2("text", 256))
    path = F.concat(F.when(F.col("source") == "src1", "/root/x/data/").otherwise("/other/"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", "sha256", T.run_key("extraction", F.col("sha256")).alias("run_key"), T.run_key("conversion", F.col("sha256"), F.sha2("lang", 256)).alias("conversion_key"), T.portable_uri(path, "/root/x", F.col("sha256")).alias("uri"))


@query("nominal_keys", "select doc_id, trim(regexp_replace(upper(replace(strip_accents(text), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')) as nominal_key from documents")
def nominal_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.nominal_key(F.col("text")).alias("nominal_key"))


@query("nominal_groups", "select nominal_key, count(*) as fragments, array_to_string(list_sort(list(doc_id)), '|') as doc_ids from (select doc_id, trim(regexp_replace(upper(replace(strip_accents(text), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')) as nominal_key from documents) group by 1 having count(*) >= 2")
def nominal_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy(T.nominal_key(F.col("text")).alias("nominal_key")).agg(F.count("*").alias("fragments"), F.array_join(F.array_sort(F.collect_list("doc_id")), "|").alias("doc_ids"))
    return rows.filter("fragments >= 2")


@query("joined_lines", r"""select doc_id, replace(replace(replace(a, 'x-' || chr(10), 'x- '), '- a', 'a'), chr(10), ' ') as joined from (select doc_id, 'Adminis- a' || doc_id || chr(10) || 'next' as a from documents)""")
def joined_lines(spark, sf_dir):
    number = F.col("doc_id").cast("string")
    lines = F.array(F.lit("  Adminis-"), F.lit(" \t "), F.concat(F.lit("a"), number), F.lit("next"))
    return table(spark, sf_dir, "documents").select("doc_id", T.join_lines(lines).alias("joined"))


@query("edition_keys", "select o_orderkey, case when o_orderkey % 3 = 0 then 'dodf:loose name ' || o_orderkey else 'dodf:' || strftime(o_orderdate, '%Y-%m-%d') || ':edicao-' || o_orderkey || case when o_orderkey % 3 = 1 then ':edicao-extra' else '' end end as document_key, case when o_orderkey % 3 = 0 then null else cast(o_orderdate as date) end as publication_date, case when o_orderkey % 3 = 0 then null else cast(o_orderkey as varchar) end as edition_number from orders")
def edition_keys(spark, sf_dir):
    key, k = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    name = F.when(k == 0, F.concat(F.lit("in/Loose Name "), key, F.lit(".pdf"))).otherwise(F.concat(F.lit("a/b/DODF "), key, F.lit(" "), F.date_format("o_orderdate", "dd-MM-yyyy"), F.when(k == 1, " Edicao Extra").otherwise(""), F.lit(".pdf")))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.edition_key(name).alias("k")).select("o_orderkey", "k.document_key", "k.publication_date", "k.edition_number")


@query("check_digits", f"with a as (select c_custkey, printf('%013d', c_custkey * 7919 % 10000000000000) || cast(c_custkey % 10 as varchar) as d from customer) select c_custkey, d as digits, cast(substr(d, 13, 1) as int) = {_check('d', 12)} and cast(substr(d, 14, 1) as int) = {_check('d', 13)} and not regexp_matches(d, '^0+$') as valid from a")
def check_digits(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("digits", F.concat(F.format_string("%013d", F.col("c_custkey") * 7919 % 10000000000000), (F.col("c_custkey") % 10).cast("string")))
    return rows.select("c_custkey", "digits", T.valid_cnpj(F.col("digits")).alias("valid"))


@query("snippets", "with a as (select doc_id, text, strpos(text, ' the ') as p from documents where contains(text, ' the ')) select doc_id, case when p - 1 > 20 then '...' else '' end || trim(regexp_replace(substr(text, greatest(0, p - 21) + 1, least(length(text), p + 24) - greatest(0, p - 21)), '\\s+', ' ', 'g')) || case when p + 24 < length(text) then '...' else '' end as snippet from a")
def snippets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.contains("text", F.lit(" the ")))
    p = F.instr("text", " the ")
    return docs.select("doc_id", T.snippet(F.col("text"), p - 1, p + 4, 20).alias("snippet"))


@query("document_search", "select doc_id, lang, source from documents where contains(lower(strip_accents(lang || ' ' || text)), 'eaux de') order by doc_id, lang, source limit 150")
def document_search(spark, sf_dir):
    return views.search(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "Eàux De", ["lang", "text"]).select("doc_id", "lang", "source")


@query("language_facets", "select lang as facet, count(*) as rows from documents group by 1")
def language_facets(spark, sf_dir):
    return views.facets(table(spark, sf_dir, "documents"), "lang")


@query("conversation_turns", "select conv_id, turn, role, 'turn-' || lpad(cast(row_number() over (partition by conv_id order by turn) as varchar), 4, '0') as id, coalesce(lag(role) over (partition by conv_id order by turn) = role, false) as continues from conversations")
def conversation_turns(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("conv_id").orderBy("turn")
    continues = F.coalesce(F.lag("role").over(order) == F.col("role"), F.lit(False))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", mentions.in_order(["turn"], "turn", 4, "conv_id").alias("id"), continues.alias("continues"))
