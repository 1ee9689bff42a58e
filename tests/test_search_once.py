"""Substring searches: each text is read once for all that is asked of it."""

from __future__ import annotations

from ledgerloom.operators import search


def test_equal_searches_are_one_until_the_end_and_rows_without_a_key_count(spark):
    rows = spark.createDataFrame([(1, "abcdef"), (None, "xabcy"), (3, "ab"), (3, "zzz")], "k int, t string")
    asked = spark.createDataFrame([(1, "abc"), (2, "ABC"), (3, "ab"), (4, "áb")], "query_id int, text string")
    found = search.containing(search.gram_index(rows, ["k"], ["t"]), asked)
    want = {(q, k) for q in (1, 2) for k in (1, None)} | {(q, k) for q in (3, 4) for k in (1, None, 3)}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    # the texts meet what is asked in the join's own condition, and query ids come after it
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains(folded") > plan.index("query_id")
