"""Queries of clustering quality and of registries with two times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import agreement, bitemporal
from ledgerloom.plans import gazette
from ledgerloom.plans.edition import Edition
from ledgerloom.queries.gazette import OBSERVED

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def merge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """If fragments of one value were merged across documents, how often would that be wrong, where truth keeps documents apart?"""
    edition = Edition(gazette.blocks(spark, sf_dir)).stored()
    value = F.nullif("value", F.lit(""))
    rows = edition.fragments.select("doc_id", "entity_type", "block_id", "start", value.alias("merged"), F.concat_ws("/", F.col("doc_id").cast("string"), "value").alias("real"))
    found = agreement.clustering_quality(rows, "merged", "real", ["doc_id", "block_id", "start"], ["entity_type"])
    return found.select("entity_type", "elements", *[F.round(c, 9).alias(c) for c in found.columns[2:]])


QUERIES["merge_quality"] = merge_quality
ORACLE["merge_quality"] = gazette.oracle(
    """select entity_type, cast(sum(n) as bigint) as elements, round(sum(n * (n - 1)) / any_value(m), 9) as pair_precision, round(sum(n * (n - 1)) / nullif(any_value(t), 0), 9) as pair_recall, round(1 - sum(n * (n - 1)) / any_value(m), 9) as false_merge_rate,
  round(sum(n * n / pn) / sum(n), 9) as bcubed_precision, round(sum(n * n / an) / sum(n), 9) as bcubed_recall
from (select *, sum(n) over (partition by entity_type, p) as pn, sum(n) over (partition by entity_type, a) as an from (
  select entity_type, case when value = '' then '!' || doc_id || block_id || start else value end as p, doc_id || '/' || value as a, cast(count(*) as double) as n from frags group by all)) c
join (select entity_type, sum(n * (n - 1)) as m from (select entity_type, case when value = '' then '!' || doc_id || block_id || start else value end as p, cast(count(*) as double) as n from frags group by all) group by 1) using (entity_type)
join (select entity_type, sum(n * (n - 1)) as t from (select entity_type, doc_id, value, cast(count(*) as double) as n from frags group by all) group by 1) using (entity_type)
group by 1""",
    *OBSERVED,
)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order tells its customer's priority for a while; every ninth takes it back, every thirteenth has no end."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = F.col("o_orderkey") % 700
    day = F.to_date("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("unit"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("name"), day.alias("valid_from"),
        F.when(F.col("o_orderkey") % 13 != 0, F.date_add(day, days.cast("int"))).alias("valid_to"), F.col("o_orderkey").alias("known_at"),
    )


LOG = """log as (select o_custkey as unit, case when o_orderkey % 9 <> 0 then o_orderpriority end as name, cast(o_orderdate as date) as valid_from,
  case when o_orderkey % 13 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 700 as int) end as valid_to, o_orderkey as known_at from orders),
sound as (select * from log where valid_to is null or valid_from < valid_to)"""


def registry_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bitemporal.timeline(_log(spark, sf_dir), "unit", "name")
    return found.select("unit", "name", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


def registry_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    asked = log.select(F.col("known_at").alias("order_key"), "unit", F.date_add("valid_from", 30).alias("valid_at"), (F.col("known_at") + 50).alias("known_at"))
    return bitemporal.as_of(asked, log, "unit", "name").select("order_key", "unit", "name")


QUERIES |= {"registry_timeline": registry_timeline, "registry_as_of": registry_as_of}
ORACLE["registry_timeline"] = f"""with {LOG},
bounds as (select unit, valid_from as d from sound union select unit, valid_to from sound where valid_to is not null),
pieces as (select unit, d, lead(d) over (partition by unit order by d) as e from bounds),
held as (select p.unit, p.d, p.e, arg_max(coalesce(s.name, ''), s.known_at) as name from pieces p join sound s on s.unit = p.unit and s.valid_from <= p.d and (s.valid_to is null or s.valid_to > p.d) group by all),
real as (select * from held where name <> ''),
runs as (select *, sum(case when same then 0 else 1 end) over (partition by unit order by d) as run from (select *, coalesce(lag(e) over w = d and lag(name) over w = name, false) as same from real window w as (partition by unit order by d)))
select unit, name, cast(min(d) as varchar) as valid_from, case when count(*) = count(e) then cast(max(e) as varchar) end as valid_to from runs group by unit, name, run"""
ORACLE["registry_as_of"] = f"""with {LOG},
asked as (select known_at as order_key, unit, valid_from + 30 as valid_at, known_at + 50 as known from log)
select order_key, a.unit, nullif(arg_max(coalesce(s.name, ''), s.known_at), '') as name from asked a left join sound s on s.unit = a.unit and s.valid_from <= a.valid_at and (s.valid_to is null or s.valid_to > a.valid_at) and s.known_at <= a.known group by 1, 2"""
