"""The semantic and the identity artifact of every document, as the JSON text that their contracts ask for.

Each part of an artifact is grouped by document by itself and then met with the others; ids are numbered inside
a document, in the order in which a program that reads one document would give them. A document's
artifact is one text, so it is one row's; parts that are tables of their own stay tables until then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import identity, mentions, observations, segmentation
from ledgerloom.plans.edition import Edition

# fixed values: words of the artifacts
SCHEMA_VERSION, SEMANTIC_TOOL, IDENTITY_TOOL = "1.0", ("semantic.py", "0.2.0"), ("identity.py", "0.1.0")
POLICY = {
    "name": "material_identity_split_first", "version": "1.0", "default": "KEEP_SEPARATE",
    "principles": ["fragments_are_immutable_evidence", "names_are_not_material_identifiers", "one_unexplained_divergence_suspends_linking", "links_are_reversible_and_versioned"],
}
CASE_CHAIN = ["verify_extraction", "verify_source_image", "seek_correction"]
CASE_REASON = "CNPJ observado não supera a validação dos dígitos verificadores."
CANDIDATE_REASON = "Coincidência nominal não constitui identidade material."
MISSING_EVIDENCE = ["nontransferable_identifier_or_complete_concordance"]

NULLS = {"ignoreNullFields": "false"}


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def _part(rows: DataFrame, name: str, order: Sequence[str], fields: Sequence[Column | str], nulls: bool = True) -> DataFrame:
    """doc_id and a JSON array of the rows' fields, in order; ids with more digits come later."""
    order = [x for c in order for x in ([F.length(c).alias("digits_"), c] if c == "id" else [c])]
    text = F.to_json(F.struct(*fields), NULLS if nulls else {})
    held = F.array_sort(F.collect_list(F.struct(*order, text.alias("text_"))))
    return rows.groupBy("doc_id").agg(F.concat(F.lit("["), F.array_join(F.transform(held, lambda x: x["text_"]), ","), F.lit("]")).alias(name))


def _artifact(documents: DataFrame, head: list[tuple[str, Column]], parts: list[DataFrame], counts: DataFrame) -> DataFrame:
    """doc_id, artifact: head, then the parts (an empty array where a document has none of one), then counts."""
    rows = documents
    for part in parts:
        rows = rows.join(part, "doc_id", "left")
    names = [c for p in parts for c in p.columns if c != "doc_id"]
    numbers = [c for c in counts.columns if c != "doc_id"]
    rows = rows.join(counts.select("doc_id", F.to_json(F.struct(*numbers)).alias("counts")), "doc_id")
    fields = [F.concat(F.lit(f'"{k}":'), v) for k, v in head] + [F.concat(F.lit(f'"{n}":'), F.coalesce(n, F.lit("[]"))) for n in names] + [F.concat(F.lit('"counts":'), F.col("counts"))]
    return rows.select("doc_id", F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("artifact"))


def _head(created_at: str, tool: tuple[str, str], more: list[tuple[str, Column]]) -> list[tuple[str, Column]]:
    named = F.to_json(F.struct(F.lit(tool[0]).alias("name"), F.lit(tool[1]).alias("version")))
    return [("schema_version", F.lit(f'"{SCHEMA_VERSION}"')), ("created_at", F.to_json(F.array(F.lit(created_at))).substr(F.lit(2), F.lit(len(created_at) + 2))), ("tool", named), *more]


def _item_id(item: str = "item") -> Column:
    return F.when(F.col(item) > 0, F.format_string("item-%05d", item))


def _section_id() -> Column:
    return F.concat(F.lit("section-"), F.lower("section"))


def numbered_observations(edition: Edition) -> dict[str, DataFrame]:
    """Mentions, entities, references, actions and provisions with their ids; of entities also the role with the id that it names."""
    found = edition.mentions.withColumn("id", mentions.in_order(["page", "ord", "start"], "processo_sei", 6))
    actions = observations.numbered_actions(edition.actions)
    entities = observations.numbered_entities(edition.entities)
    named = actions.select("doc_id", "block_id", F.col("start").alias("action_start"), F.col("id").alias("action_id"))
    persons = entities.filter("entity_type = 'person'").select("doc_id", "block_id", "action_start", F.col("id").alias("person_id"))
    entities = entities.join(named, ["doc_id", "block_id", "action_start"], "left").join(persons, ["doc_id", "block_id", "action_start"], "left")
    role = F.when(F.col("role") == "subject_of", F.concat_ws(":", "role", "action_id")).when(F.col("role") == "current_position_of", F.concat_ws(":", "role", "person_id")).otherwise(F.col("role"))
    entities = entities.withColumn("role", role).drop("action_id", "person_id")
    return {"mentions": found, "entities": entities, "actions": actions, "references": observations.numbered_references(edition.references), "provisions": observations.numbered_provisions(edition.provisions)}


def semantic(edition: Edition, sources: DataFrame, created_at: str) -> DataFrame:
    """doc_id, artifact; sources: doc_id, uri, sha256 of each document. Store the edition first: its segmentation is read several times."""
    made = numbered_observations(edition)
    span = ["block_id", "page", "start", "end"]
    blocks = edition.assigned
    assignments = [F.col("block_id"), F.col("category"), F.when(F.col("category").isin("section_heading", "editorial_context", "published_item"), _section_id()).alias("section_id"), F.when(F.col("context") > 0, F.format_string("context-%04d", "context")).alias("context_id"), _item_id().alias("item_id")]
    contexts = segmentation.contexts(blocks)
    in_item = _item_id().alias("item_id")
    parts = [
        _part(edition.sections.withColumn("id", _section_id()), "sections", ["id"], ["id", "label", "start_block_id", "start_page"]),
        _part(contexts, "editorial_contexts", ["context"], [F.format_string("context-%04d", "context").alias("id"), _section_id().alias("section_id"), "level", "label", "block_ids", "page", "breadcrumb", F.lit("observed_editorial_heading").alias("kind")]),
        _part(edition.items, "published_items", ["item"], [_item_id().alias("id"), _section_id().alias("section_id"), "breadcrumb", "title", "item_type", "number", "date_literal", "act_date", "block_ids", "start_page", "end_page", "text"]),
        _part(made["provisions"], "provisions", ["id"], ["id", "kind", "label", in_item, *span]),
        _part(made["actions"], "actions", ["id"], ["id", "verb", "value_original", in_item, *span, F.lit("observed_text").alias("status"), F.lit("priority_action_verbs_v1").alias("method")]),
        _part(made["entities"], "entity_mentions", ["id"], ["id", "entity_type", "value_original", "value_normalized", "role", in_item, *span, "method"]),
        _part(made["references"], "references", ["id"], ["id", "reference_type", "value_original", "value_normalized", "valid", in_item, *span, "method"]),
        _part(blocks, "block_assignments", ["n"], assignments, nulls=False),
    ]
    source = F.to_json(F.struct(F.col("uri").alias("structured_uri"), F.col("sha256").alias("document_sha256")))
    return _artifact(sources, _head(created_at, SEMANTIC_TOOL, [("source", source)]), parts, observations.semantic_counts(blocks))


def fragments(edition: Edition) -> DataFrame:
    """Numbered fragments of an edition; what an entity's role names isn't asked for."""
    found = edition.mentions.withColumn("id", mentions.in_order(["page", "ord", "start"], "processo_sei", 6))
    return identity.numbered_fragments(observations.numbered_entities(edition.entities), found, observations.numbered_references(edition.references))


def identities(found: DataFrame, sources: DataFrame, created_at: str) -> DataFrame:
    """doc_id, artifact; found: numbered fragments, better stored; sources: doc_id, uri (of the semantic artifact), mentions_uri, sha256."""
    none = F.lit(None).cast("string")
    rule = F.col("reason")
    parts = [
        _part(found, "fragments", ["number"], ["id", "entity_type", "source_kind", "source_id", "label", "block_id", "page", "start", "end", _item_id().alias("item_id"), F.lit("observed_fragment").alias("status"), "method"]),
        _part(identity.numbered_assertions(found), "assertions", ["id"], ["id", "fragment_id", "attribute", "value_original", "value_normalized", "materiality_class", none.alias("scope"), none.alias("valid_from"), none.alias("valid_to"), "method"]),
        _part(identity.numbered_identifiers(found), "identifiers", ["id"], ["id", "fragment_id", "identifier_type", "value_original", "value_normalized", "materiality_class", "scope", "is_valid", "transferability", "method"]),
        _part(identity.numbered_canonical(identity.canonical(found)), "canonical_entities", ["id"], ["id", "entity_type", "display_name", F.lit("materialized").alias("status"), "materiality_basis", "created_by_rule"]),
        _part(identity.numbered_links(found), "identity_links", ["id"], ["id", "fragment_id", "canonical_entity_id", F.lit("AUTO_LINK").alias("decision"), "reason", F.array(rule, F.lit("no_observed_divergence")).alias("rules"), F.lit(False).alias("has_divergence"), F.lit("automatic").alias("review_status"), F.lit(1).alias("version")]),
        _part(identity.candidate_members(found), "candidate_groups", ["id"], ["id", "entity_type", "candidate_key", "fragment_ids", F.lit("KEEP_SEPARATE").alias("decision"), F.lit(CANDIDATE_REASON).alias("reason"), _strings(["N"]).alias("materiality_classes"), _strings(MISSING_EVIDENCE).alias("missing_evidence")]),
        _part(identity.numbered_cases(found), "resolution_cases", ["id"], ["id", F.lit("legal_organization").alias("entity_type"), F.array("fragment_id").alias("fragment_ids"), F.lit("invalid_identifier").alias("case_type"), F.lit("unresolved").alias("status"), _strings(["cnpj_checksum_invalid"]).alias("divergences"), _strings(CASE_CHAIN).alias("analysis_chain"), F.lit("UNRESOLVED").alias("recommended_decision"), F.lit(CASE_REASON).alias("reason")]),
    ]
    policy = F.to_json(F.struct(*[(_strings(v) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in POLICY.items()]))
    source = F.to_json(F.struct(F.col("uri").alias("semantic_uri"), "mentions_uri", F.col("sha256").alias("document_sha256")))
    return _artifact(sources, _head(created_at, IDENTITY_TOOL, [("policy", policy), ("source", source)]), parts, identity.identity_counts(found))
