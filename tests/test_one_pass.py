"""Queries over gazette blocks that read the segmentation once, and what the others store."""

from __future__ import annotations

import pytest

from ledgerloom.operators import identity, segmentation
from ledgerloom.plans import edition
from ledgerloom.queries import gazette

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stored(monkeypatch):
    found = []
    for module in (edition, gazette):
        monkeypatch.setattr(module, "checkpointed", lambda df: found.append(df.columns) or df)
    return found


@pytest.mark.parametrize("name", ["entity_mentions", "canonical_entities", "semantic_counts", "candidate_ids", "view_entity_occurrences", "explorer_related_items"])
def test_orders_are_read_once_and_nothing_is_written(spark, stored, name):
    plan = gazette.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert not stored and plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_process_items_store_only_what_they_read(spark, stored):
    gazette.QUERIES["view_process_items"](spark, SF)
    assert stored == [["doc_id", "page", "n", "block_id", "text", "noise", "item", "item_title"]]


def test_titles_of_blocks_are_those_of_their_items(spark):
    found = segmentation.assign(gazette.gazette.blocks(spark, SF), titled=True)
    titles = {(r.doc_id, r.item): r.title for r in segmentation.items(found).collect()}
    rows = found.select("doc_id", "item", "item_title").collect()
    assert titles and all(r.item_title == titles.get((r.doc_id, r.item)) for r in rows)


def test_identifiers_are_numbered_behind_entities_that_are_only_counted(spark):
    e = edition.Edition(gazette.gazette.blocks(spark, SF))
    columns = ["doc_id", "id", "entity_type", "source_kind", "label", "block_id", "page", "start", "end", "item", "method", "value", "valid"]
    every = gazette.artifacts.fragments(e).filter("source_kind <> 'semantic_entity_mention'").select(columns)
    found = identity.numbered_identified(e.assigned).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, every.collect()))


def test_links_are_numbered_from_one_small_table(spark, stored):
    gazette.QUERIES["link_ids"](spark, SF)
    assert len(stored) == 1 and "text" not in stored[0] and "source_id" not in stored[0]
