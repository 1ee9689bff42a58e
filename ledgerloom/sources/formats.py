"""Contracts of the semantic and of the identity artifact, as JSON Schema. Names, order and bounds are the format's."""

from __future__ import annotations

from typing import Any

TEXT, WHOLE, TRUTH = {"type": "string"}, {"type": "integer"}, {"type": "boolean"}
NAME = {"type": "string", "minLength": 1}
MAYBE = {"type": ["string", "null"]}
PAGE, START, END = {**WHOLE, "minimum": 1}, {**WHOLE, "minimum": 0}, {**WHOLE, "minimum": 1}
URI = {"type": "string", "pattern": "^(repo|urn):"}
SHA256 = {"type": "string", "pattern": "^[0-9a-f]{64}$"}
STAMP = {"type": "string", "format": "date-time"}


def _object(fields: dict[str, Any], required: list[str] | None = None) -> dict[str, Any]:
    return {"type": "object", "additionalProperties": False, "required": list(fields) if required is None else required, "properties": fields}


def _list(items: dict[str, Any], **bounds: Any) -> dict[str, Any]:
    return {"type": "array", **bounds, "items": items}


def _counters(least_one: list[str], others: list[str]) -> dict[str, Any]:
    return _object({**{c: {**WHOLE, "minimum": 1} for c in least_one}, **{c: {**WHOLE, "minimum": 0} for c in others}})


def _one_of(*values: str) -> dict[str, Any]:
    return {"enum": list(values)}


SPAN = {"block_id": TEXT, "page": PAGE, "start": START, "end": END}

SEMANTIC = _object({
    "schema_version": {"const": "1.0"}, "created_at": STAMP, "tool": _object({"name": TEXT, "version": TEXT}),
    "source": _object({"structured_uri": URI, "document_sha256": SHA256}),
    "sections": _list(_object({"id": TEXT, "label": TEXT, "start_block_id": TEXT, "start_page": PAGE})),
    "editorial_contexts": _list(_object({
        "id": TEXT, "section_id": TEXT, "level": {**WHOLE, "minimum": 1, "maximum": 3}, "label": TEXT, "block_ids": _list(TEXT, minItems=1), "page": PAGE,
        "breadcrumb": _list(TEXT), "kind": {"const": "observed_editorial_heading"},
    })),
    "published_items": _list(_object({
        "id": TEXT, "section_id": TEXT, "breadcrumb": _list(TEXT), "title": TEXT, "item_type": TEXT, "number": MAYBE, "date_literal": MAYBE,
        "act_date": {**MAYBE, "format": "date"}, "block_ids": {**_list(TEXT, minItems=1), "uniqueItems": True}, "start_page": PAGE, "end_page": PAGE, "text": TEXT,
    })),
    "provisions": _list(_object({"id": TEXT, "kind": {"const": "article"}, "label": TEXT, "item_id": TEXT, **SPAN})),
    "actions": _list(_object({"id": TEXT, "verb": TEXT, "value_original": TEXT, "item_id": TEXT, **SPAN, "status": {"const": "observed_text"}, "method": TEXT})),
    "entity_mentions": _list(_object({"id": TEXT, "entity_type": _one_of("person", "organization", "position"), "value_original": TEXT, "value_normalized": TEXT, "role": TEXT, "item_id": MAYBE, **SPAN, "method": TEXT})),
    "references": _list(_object({"id": TEXT, "reference_type": _one_of("cnpj", "monetary_value", "norm"), "value_original": TEXT, "value_normalized": TEXT, "valid": {"type": ["boolean", "null"]}, "item_id": TEXT, **SPAN, "method": TEXT})),
    "block_assignments": _list(_object({
        "block_id": TEXT,
        "category": _one_of("noise", "summary", "front_matter", "publication_header", "publication_metadata", "section_heading", "editorial_context", "published_item"),
        "section_id": TEXT, "context_id": TEXT, "item_id": TEXT,
    }, required=["block_id", "category"])),
    "counts": _counters(["blocks_total", "sections"], ["contexts", "published_items", "multi_page_items", "unclassified_items", "actions", "entity_mentions", "provisions", "references"]),
})

ENTITY = _one_of("person", "organization", "organizational_unit", "position", "process", "legal_organization", "norm")
CLASS = _one_of("U", "S", "B", "T", "C", "N", "X")

IDENTITY = _object({
    "schema_version": {"const": "1.0"}, "created_at": STAMP, "tool": _object({"name": {"const": "identity.py"}, "version": TEXT}),
    "policy": _object({"name": {"const": "material_identity_split_first"}, "version": TEXT, "default": {"const": "KEEP_SEPARATE"}, "principles": _list(TEXT, minItems=4, uniqueItems=True)}),
    "source": _object({"semantic_uri": URI, "mentions_uri": URI, "document_sha256": SHA256}),
    "fragments": _list(_object({
        "id": NAME, "entity_type": ENTITY, "source_kind": _one_of("semantic_entity_mention", "evidence_mention", "semantic_reference"), "source_id": NAME, "label": TEXT,
        **SPAN, "block_id": NAME, "item_id": MAYBE, "status": {"const": "observed_fragment"}, "method": TEXT,
    })),
    "assertions": _list(_object({
        "id": NAME, "fragment_id": NAME, "attribute": TEXT, "value_original": TEXT, "value_normalized": TEXT, "materiality_class": CLASS, "scope": MAYBE,
        "valid_from": MAYBE, "valid_to": MAYBE, "method": TEXT,
    })),
    "identifiers": _list(_object({
        "id": NAME, "fragment_id": NAME, "identifier_type": _one_of("processo_sei", "cnpj"), "value_original": TEXT, "value_normalized": TEXT, "materiality_class": CLASS, "scope": TEXT,
        "is_valid": TRUTH, "transferability": _one_of("nontransferable", "scoped_nontransferable", "unknown"), "method": TEXT,
    })),
    "canonical_entities": _list(_object({"id": NAME, "entity_type": ENTITY, "display_name": TEXT, "status": {"const": "materialized"}, "materiality_basis": CLASS, "created_by_rule": TEXT})),
    "identity_links": _list(_object({
        "id": NAME, "fragment_id": NAME, "canonical_entity_id": NAME, "decision": {"const": "AUTO_LINK"}, "reason": TEXT, "rules": _list(TEXT, minItems=1),
        "has_divergence": {"const": False}, "review_status": {"const": "automatic"}, "version": {**WHOLE, "minimum": 1},
    })),
    "candidate_groups": _list(_object({
        "id": NAME, "entity_type": ENTITY, "candidate_key": TEXT, "fragment_ids": _list(NAME, minItems=2, uniqueItems=True), "decision": _one_of("KEEP_SEPARATE", "UNRESOLVED", "PROPOSE_LINK"),
        "reason": TEXT, "materiality_classes": _list(CLASS), "missing_evidence": _list(TEXT),
    })),
    "resolution_cases": _list(_object({
        "id": NAME, "entity_type": ENTITY, "fragment_ids": _list(NAME, minItems=1, uniqueItems=True), "case_type": TEXT, "status": _one_of("open", "unresolved", "resolved", "rejected", "reopened"),
        "divergences": _list(TEXT, minItems=1), "analysis_chain": _list(TEXT, minItems=1), "recommended_decision": _one_of("IDENTITY_CASE", "DISTINCT", "UNRESOLVED", "REJECTED_LINK", "REOPENED"), "reason": TEXT,
    })),
    "counts": _counters([], ["fragments", "assertions", "identifiers", "canonical_entities", "identity_links", "candidate_groups", "resolution_cases", "unlinked_fragments"]),
})
