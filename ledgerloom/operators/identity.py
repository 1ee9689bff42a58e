"""Conservative identity: names never merge; only scoped process numbers and valid identifiers do.

Everything is grouped inside a document. Fragments carry the value they could be linked by; groups
are made by that value, so a common one is pre-aggregated before its rows meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import NOTHING, Rule, extract, let
from ledgerloom.operators.mentions import PROCESS_RULES, in_order, visible
from ledgerloom.operators.observations import entity_count

RULES = {"process": "same_scoped_process_identifier_v1", "legal_organization": "same_valid_cnpj_v1"}


def named(entities: DataFrame) -> DataFrame:
    """The fragments that hold a name; value: its nominal key."""
    id_ = [F.col("id").alias("source_id"), "value_original"] if "id" in entities.columns else []
    key = let(F.col("value_normalized"), T.nominal_key).alias("value")
    return entities.select("doc_id", "entity_type", F.lit("semantic_entity_mention").alias("source_kind"), F.col("value_original").alias("label"), "block_id", "page", "start", "end", "item", "method", key, F.lit(None).cast("boolean").alias("valid"), *id_)


def fragments(entities: DataFrame, mentions: DataFrame, references: DataFrame) -> DataFrame:
    """doc_id, entity_type, source_kind, label, block_id, page, start, end, item, method, value, valid.

    value: the nominal key of an entity, the process number or the digits of an identifier. Where all three
    come with id, fragments have source_id and value_original too.
    """
    place = ["block_id", "page", "start", "end"]
    ids = lambda rows: [F.col("id").alias("source_id"), "value_original"] if "id" in rows.columns else []
    b = mentions.filter(F.col("rule") == "processo_sei").select("doc_id", F.lit("process").alias("entity_type"), F.lit("evidence_mention").alias("source_kind"), F.col("value_normalized").alias("label"), *place, F.lit(None).cast("int").alias("item"), F.lit("process_number_observation_v1").alias("method"), F.col("value_normalized").alias("value"), F.lit(True).alias("valid"), *ids(mentions))
    c = references.filter(F.col("reference_type") == "cnpj").select("doc_id", F.lit("legal_organization").alias("entity_type"), F.lit("semantic_reference").alias("source_kind"), F.col("value_original").alias("label"), *place, "item", "method", T.digits(F.col("value_normalized")).alias("value"), "valid", *ids(references))
    return named(entities).unionByName(b).unionByName(c)


_IDENTIFIERS = [*PROCESS_RULES, Rule("cnpj", V.PATTERNS["cnpj"])]
_PROCESS = PROCESS_RULES[0].name


def _identified(found: DataFrame, *more: str) -> DataFrame:
    process = F.col("rule") == _PROCESS
    value = let(F.col("value"), lambda v: F.when(process, T.normalize_process(v)).otherwise(T.digits(v)))
    found = found.withColumns({"made": value, "sound": F.when(process, True).otherwise(T.valid_cnpj(F.col("value")))})
    kind = lambda a, b: F.when(process, a).otherwise(b)
    return found.select(
        "doc_id", kind("process", "legal_organization").alias("entity_type"), kind("evidence_mention", "semantic_reference").alias("source_kind"), kind(F.col("made"), F.col("value")).alias("label"),
        "block_id", "page", "start", "end", F.when(~process, F.col("item")).alias("item"), kind("process_number_observation_v1", "cnpj_checksum_v1").alias("method"),
        F.col("made").alias("value"), F.col("sound").alias("valid"), *more,
    )


def identified(assigned: DataFrame) -> DataFrame:
    """The fragments that hold an identifier, straight from segmented blocks: process numbers of all visible ones, identifiers of those in items."""
    return _identified(extract(visible(assigned), "text", _IDENTIFIERS, {"cnpj": F.col("item") > 0}))


def numbered_identified(assigned: DataFrame) -> DataFrame:
    """identified with number and id, as numbered_fragments gives them: behind the entities of their document, which are only counted."""
    entities = F.when(F.col("context") > 0, 1).when(F.col("item") > 0, entity_count(F.col("text"))).otherwise(0)
    counted = let(entities, lambda n: F.when(n > 0, F.array(F.struct(F.lit("entities").alias("rule"), F.lit("").alias("rule_version"), F.lit(0).alias("start"), n.alias("end"), F.lit("").alias("value")))).otherwise(F.expr(NOTHING)))
    found = extract(visible(assigned), "text", _IDENTIFIERS, {"cnpj": F.col("item") > 0}, (counted,))
    kind = F.array_position(F.array(*map(F.lit, ("entities", _PROCESS, "cnpj"))), F.col("rule"))
    before = Window.partitionBy("doc_id").orderBy(kind, "n", "start").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("number", F.sum(F.when(F.col("rule") == "entities", F.col("end")).otherwise(1)).over(before))
    return _identified(found.filter(F.col("rule") != "entities"), "number").withColumn("id", F.format_string("fragment-%06d", "number"))


def same_document(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left, failing where its document's hash isn't right's; both have doc_id and sha256."""
    rows = left.join(right.select("doc_id", F.col("sha256").alias("other_")), "doc_id")
    return rows.filter(F.coalesce(F.when(F.col("sha256") == F.col("other_"), True), F.raise_error(F.lit("artifacts of different documents")).cast("boolean"))).drop("other_")


def assertions(found: DataFrame) -> DataFrame:
    rows = found.filter(F.col("source_kind") == "semantic_entity_mention")
    return rows.select("doc_id", "block_id", "start", "entity_type", F.when(F.col("entity_type") == "position", "title").otherwise("name").alias("attribute"), "label", F.col("value").alias("value_normalized"), F.lit("N").alias("materiality_class"))


def identifiers(found: DataFrame) -> DataFrame:
    rows = found.filter(F.col("source_kind") != "semantic_entity_mention")
    process = F.col("entity_type") == "process"
    return rows.select(
        "doc_id", "block_id", "start", F.when(process, "processo_sei").otherwise("cnpj").alias("identifier_type"), "label", F.col("value").alias("value_normalized"),
        F.when(process, "S").otherwise("U").alias("materiality_class"), F.when(process, "processo_administrativo_df").otherwise("brasil").alias("scope"),
        F.col("valid").alias("is_valid"), F.when(process, "scoped_nontransferable").otherwise("nontransferable").alias("transferability"),
    )


def _material(found: DataFrame) -> DataFrame:
    return found.filter(F.col("entity_type").isin(*RULES) & F.col("valid"))


def _entity() -> dict[str, Column]:
    """What a material value alone says of its entity, so that no fragment has to be joined with it."""
    organisation = F.col("entity_type") == "legal_organization"
    return {
        "display_name": F.when(organisation, F.concat(F.lit("CNPJ "), "value")).otherwise(F.col("value")),
        "materiality_basis": F.when(organisation, "U").otherwise("S"),
        "created_by_rule": F.when(organisation, RULES["legal_organization"]).otherwise(RULES["process"]),
    }


def canonical(found: DataFrame) -> DataFrame:
    """doc_id, entity_type, value, display_name, materiality_basis, created_by_rule: one per process number and valid identifier."""
    return _material(found).select("doc_id", "entity_type", "value").distinct().withColumns(_entity())


def links(found: DataFrame) -> DataFrame:
    """One link per fragment with a material value, to the entity of that value (named by doc_id, entity_type, value)."""
    entity = _entity()
    rows = _material(found).withColumn("reason", entity["created_by_rule"]).withColumn("display_name", entity["display_name"])
    return rows.select("doc_id", "entity_type", "value", "display_name", "block_id", "page", "start", "end", "label", "source_kind", F.lit("AUTO_LINK").alias("decision"), "reason", F.array("reason", F.lit("no_observed_divergence")).alias("rules"))


def candidate_groups(found: DataFrame, least: int = 2) -> DataFrame:
    """Names that several fragments share: kept separate. doc_id, entity_type, candidate_key, fragments, decision."""
    names = found.filter(F.col("source_kind") == "semantic_entity_mention")
    groups = names.groupBy("doc_id", "entity_type", F.col("value").alias("candidate_key")).agg(F.count("*").alias("fragments"))
    return groups.filter(F.col("fragments") >= least).withColumn("decision", F.lit("KEEP_SEPARATE"))


def cases(found: DataFrame) -> DataFrame:
    """One unresolved case per identifier whose check digits are wrong."""
    bad = found.filter((F.col("entity_type") == "legal_organization") & ~F.col("valid"))
    return bad.select("doc_id", "block_id", "start", "label", F.lit("invalid_identifier").alias("case_type"), F.lit("unresolved").alias("status"), F.lit("cnpj_checksum_invalid").alias("divergence"), F.lit("UNRESOLVED").alias("recommended_decision"))


def identity_counts(found: DataFrame) -> DataFrame:
    """doc_id and its eight counters: fragments are counted by value first, and values by document."""
    linked = F.col("entity_type").isin(*RULES) & F.coalesce("valid", F.lit(False))
    values = found.groupBy("doc_id", "entity_type", "source_kind", "value", linked.alias("linked")).agg(F.count("*").alias("n"))
    name, n = F.col("source_kind") == "semantic_entity_mention", F.col("n")
    total = lambda c: F.sum(F.when(c, n).otherwise(0))
    return values.groupBy("doc_id").agg(
        F.sum("n").alias("fragments"), total(name).alias("assertions"), total(~name).alias("identifiers"),
        F.count_if("linked").alias("canonical_entities"), total(F.col("linked")).alias("identity_links"),
        total((F.col("entity_type") == "legal_organization") & ~F.col("linked")).alias("resolution_cases"),
        total(~F.col("linked")).alias("unlinked_fragments"), F.count_if(name & (n >= 2)).alias("candidate_groups"),
    )


def numbered_fragments(entities: DataFrame, mentions: DataFrame, references: DataFrame) -> DataFrame:
    """Fragments with source_id, value_original, number and id: entities first, then process numbers, then identifiers, each in the order of their ids.

    All three come with id, as their numbered_... functions give it.
    """
    kinds = ("semantic_entity_mention", "evidence_mention", "semantic_reference")
    found = fragments(entities, mentions, references)
    order = F.array_position(F.array(*map(F.lit, kinds)), F.col("source_kind"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy(order, F.length("source_id"), "source_id"))
    return found.withColumn("number", number).withColumn("id", F.format_string("fragment-%06d", "number"))


def numbered_assertions(found: DataFrame) -> DataFrame:
    """Assertions of numbered fragments with id and fragment_id; entities are the first fragments, so the numbers are the same."""
    rows = found.filter(F.col("source_kind") == "semantic_entity_mention")
    attribute = F.when(F.col("entity_type") == "position", "title").otherwise("name")
    return rows.select("doc_id", F.format_string("assertion-%06d", "number").alias("id"), F.col("id").alias("fragment_id"), attribute.alias("attribute"), "value_original", F.col("value").alias("value_normalized"), F.lit("N").alias("materiality_class"), F.lit("exact_nominal_normalization_v1").alias("method"))


def numbered_identifiers(found: DataFrame) -> DataFrame:
    """Identifiers of numbered fragments with id and fragment_id, in the fragments' order."""
    rows = found.filter(F.col("source_kind") != "semantic_entity_mention").withColumn("number", F.row_number().over(Window.partitionBy("doc_id").orderBy("number")))
    process = F.col("entity_type") == "process"
    return rows.select(
        "doc_id", F.format_string("identifier-%06d", "number").alias("id"), F.col("id").alias("fragment_id"), F.when(process, "processo_sei").otherwise("cnpj").alias("identifier_type"),
        "value_original", F.col("value").alias("value_normalized"), F.when(process, "S").otherwise("U").alias("materiality_class"),
        F.when(process, "processo_administrativo_df").otherwise("brasil").alias("scope"), F.col("valid").alias("is_valid"),
        F.when(process, "scoped_nontransferable").otherwise("nontransferable").alias("transferability"), F.when(process, "processo_sei_regex_v1").otherwise("cnpj_checksum_v1").alias("method"),
    )


def numbered_links(found: DataFrame) -> DataFrame:
    """Links of numbered fragments with id, fragment_id and canonical_entity_id: entities by kind and value, each one's fragments in their order."""
    each = [F.col("entity_type") != "process", F.col("value")]
    document = Window.partitionBy("doc_id")
    rows = _material(found).withColumn("entity", F.dense_rank().over(document.orderBy(*each))).withColumn("link", F.row_number().over(document.orderBy(*each, "number")))
    return rows.select("doc_id", F.format_string("link-%06d", "link").alias("id"), F.col("id").alias("fragment_id"), F.format_string("canonical-%06d", "entity").alias("canonical_entity_id"), _entity()["created_by_rule"].alias("reason"))


def numbered_cases(found: DataFrame) -> DataFrame:
    """Cases of numbered fragments with id and fragment_id, in the fragments' order."""
    bad = found.filter((F.col("entity_type") == "legal_organization") & ~F.col("valid")).withColumn("number", F.row_number().over(Window.partitionBy("doc_id").orderBy("number")))
    return bad.select("doc_id", F.format_string("case-%06d", "number").alias("id"), F.col("id").alias("fragment_id"))


def candidate_members(found: DataFrame, least: int = 2) -> DataFrame:
    """doc_id, id, entity_type, candidate_key, fragment_ids (in order) of the names that several numbered fragments share."""
    names = found.filter(F.col("source_kind") == "semantic_entity_mention")
    members = F.array_sort(F.collect_list(F.struct("number", "id")))
    groups = names.groupBy("doc_id", "entity_type", F.col("value").alias("candidate_key")).agg(members.alias("m")).filter(F.size("m") >= least)
    return numbered_candidates(groups).select("doc_id", "id", "entity_type", "candidate_key", F.col("m.id").alias("fragment_ids"))


def numbered_canonical(entities: DataFrame) -> DataFrame:
    """Canonical entities with id: process numbers by value, then identifiers by value."""
    return entities.withColumn("id", in_order([F.col("entity_type") != "process", "value"], "canonical", 6))


def numbered_candidates(groups: DataFrame) -> DataFrame:
    return groups.withColumn("id", in_order(["entity_type", "candidate_key"], "candidate", 6))
