"""The explorer's items come from one pass over the segmentation, and nothing is stored for them."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import observations as O
from ledgerloom.operators import views
from ledgerloom.plans import edition
from ledgerloom.queries import gazette

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_nothing_is_stored_and_orders_are_read_once(spark, monkeypatch):
    stored = []
    for module in (edition, gazette):
        monkeypatch.setattr(module, "checkpointed", lambda df: stored.append(df.columns) or df)
    plan = gazette.QUERIES["explorer_items"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not stored and plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_links_equal_those_of_the_tables_also_without_a_document(spark):
    blocks = gazette.gazette.blocks(spark, SF).filter("doc_id % 7 = 1").withColumn("doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("doc_id")))
    e = edition.Edition(blocks).stored()
    groups, processes = views.entity_groups(e.entities, e.items), views.process_groups(e.mentions, e.assigned)
    want = views.item_links(e.items, O.numbered_actions(e.actions), O.numbered_references(e.references), e.provisions, groups, processes)
    got = views.item_links_at_once(e.assigned)
    rows = lambda x: sorted(map(str, x.select("doc_id", "item", "title", "actions", "entities", "references", "processes", "provision_count").collect()))
    assert any("doc_id=None" in r for r in rows(want)) and rows(got) == rows(want)
