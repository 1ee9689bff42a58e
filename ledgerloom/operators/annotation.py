"""Rules of human annotation batches, as rows that break them.

batches: batch_id, mode, automatic_artifacts (array of string), document_sha256, page_count,
pages (array of int), records (array of struct id, annotation_type, task_type, judgment,
target string, rationale, error_categories array, fragment_ids array, evidence array of struct
document_sha256, page, start, end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import vocabulary as V

RECORD = (
    "struct<id:string,annotation_type:string,task_type:string,judgment:string,target:string,rationale:string,"
    "error_categories:array<string>,fragment_ids:array<string>,evidence:array<struct<document_sha256:string,page:int,start:int,end:int>>>"
)
BATCH = f"batch_id string, mode string, automatic_artifacts array<string>, document_sha256 string, page_count int, pages array<int>, records array<{RECORD}>"
INDEPENDENT = ("blind_primary", "independent_second")


def _broken(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))


def _size(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def violations(batches: DataFrame) -> DataFrame:
    """batch_id, record_id (null for the batch itself), rule, times."""
    whole = {
        "scope_beyond_document": F.exists("pages", lambda p: p > F.col("page_count")),
        "automatic_input": F.col("mode").isin(*INDEPENDENT) & (_size("automatic_artifacts") > 0),
    }
    a = batches.select("batch_id", F.lit(None).cast("string").alias("record_id"), F.explode(_broken(whole)).alias("rule"))
    rows = batches.select("batch_id", "mode", "document_sha256", "pages", F.explode("records").alias("r")).select("batch_id", "mode", "document_sha256", "pages", "r.*")
    kind, judgment, mode = F.col("annotation_type"), F.col("judgment"), F.col("mode")
    allowed = F.lit(False)
    for k, js in V.JUDGMENTS.items():
        allowed = allowed | ((kind == k) & judgment.isin(*js))
    rules = {
        "independent_only_observes": mode.isin(*INDEPENDENT) & ((kind != "observation") | F.col("target").isNotNull()),
        "assisted_evaluates": (mode == "assisted_review") & ~kind.isin("evaluation", "identity_decision"),
        "adjudication_only": (mode == "adjudication") & (kind != "adjudication"),
        "judgment_of_type": ~allowed,
        "target_missing": judgment.isin("CONFIRMED", "REJECTED") & F.col("target").isNull(),
        "error_category_missing": judgment.isin("REJECTED", "MISSING") & (_size("error_categories") == 0),
        "identity_incomplete": (kind == "identity_decision") & ((F.col("task_type") != "identity_resolution") | (_size("fragment_ids") < 2)),
        "rationale_missing": judgment.isin("REJECTED", "AMBIGUOUS", "SAME_ENTITY", "DISTINCT_ENTITIES", "UNRESOLVED") & (F.coalesce("rationale", F.lit("")) == ""),
    }
    b = rows.select("batch_id", F.col("id").alias("record_id"), F.explode(_broken(rules)).alias("rule"))
    repeated = rows.groupBy("batch_id", "id").agg(F.count("*").alias("n")).filter("n > 1").select("batch_id", F.col("id").alias("record_id"), F.lit("repeated_id").alias("rule"))
    pieces = rows.select("batch_id", "document_sha256", "pages", "id", F.explode("evidence").alias("e"))
    start, end = F.col("e.start"), F.col("e.end")
    found = {
        "evidence_of_other_document": F.col("e.document_sha256") != F.col("document_sha256"),
        "evidence_out_of_scope": ~F.array_contains("pages", F.col("e.page")),
        "evidence_span": (start.isNull() != end.isNull()) | (end <= start),
    }
    c = pieces.select("batch_id", F.col("id").alias("record_id"), F.explode(_broken(found)).alias("rule"))
    return a.unionByName(b).unionByName(repeated).unionByName(c).groupBy("batch_id", "record_id", "rule").agg(F.count("*").alias("times"))


def agreement(reference: DataFrame, found: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """by, true_positive, false_positive, false_negative of distinct keys; for precision and recall."""
    a = reference.select(*keys).distinct().withColumn("in_a", F.lit(True))
    b = found.select(*keys).distinct().withColumn("in_b", F.lit(True))
    rows = a.join(b, keys, "full")
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return rows.groupBy(*by).agg(F.count_if(both).alias("true_positive"), F.count_if(F.col("in_a").isNull()).alias("false_positive"), F.count_if(F.col("in_b").isNull()).alias("false_negative"))
