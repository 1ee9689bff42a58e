"""What is stored lies by document, so that no part of an artifact is shuffled again."""

from __future__ import annotations

import os

import pytest

from ledgerloom.queries import gazette

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["semantic_contract", "identity_contract"])
def test_parts_of_artifacts_are_not_shuffled(spark, name):
    plan = gazette.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange hashpartitioning" not in plan
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
