"""Searches whose index isn't stored."""

from __future__ import annotations

from ledgerloom.operators import search


def test_searches_group_the_postings_of_their_terms_only(spark):
    rows = spark.createDataFrame([(1, "portaria de junho"), (2, "decreto de março")], "id int, text string")
    asked = spark.createDataFrame([(1, "portarias")], "query_id int, phrase string")
    found = search.phrases(search.text_index(rows, ["id"]), asked)
    assert [tuple(r) for r in found.collect()] == [(1, 1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("LeftSemi") > plan.rindex("flatten(")
