"""How often the segmentation sorts a document's blocks."""

from __future__ import annotations

from ledgerloom.operators import segmentation


def test_blocks_are_sorted_twice_and_never_backwards(spark):
    rows = spark.createDataFrame([(1, 1, 1, "b1", "SEÇÃO I", "h1", False)], "doc_id long, page int, ord int, block_id string, text string, role string, noise boolean")
    plan = segmentation.assign(rows)._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert plan.count("Sort [") == 2 and "DESC" not in plan
