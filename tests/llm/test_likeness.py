"""Operator 10: a small change leaves most of a tree's leaves as they were."""

from __future__ import annotations

from ledgerloom.llm import merkle
from llm.conftest import prose
from pyspark.sql import functions as F


def test_likeness_survives_insertions(spark):
    one = prose(3, 300).replace("\n", "")
    words = one.split(" ")
    other = prose(4, 300).replace("\n", "")
    pairs = [
        (0, one, one), (1, one, "new " + one), (2, one, " ".join(words[1:])), (3, one, " ".join([*words[:150], "some", "new", "words", *words[150:]])), (4, one, one + " more"),
        (5, one, other), (6, "", ""), (7, one, ""), (8, "a " * 50, "a " * 49), (9, "   ", "  "),
    ]
    rows = spark.createDataFrame(pairs, "k int, a string, b string")
    sides = rows.select("k", *[merkle.leaves(merkle.tree(F.col(c))).alias(c) for c in "ab"])
    got = {r.k: r.x for r in sides.select("k", merkle.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    assert got[0] == got[6] == 1.0 and got[7] == 0.0 and got[9] == 0.0
    assert all(got[k] > 0.9 for k in (1, 2, 3, 4)) and got[5] < 0.1
    whole = spark.createDataFrame([(one,), ("a  b   c ",), (" x",), ("es es",)], "t string")
    back = F.array_join(F.regexp_extract_all("t", F.lit(merkle.LEAF), F.lit(0)), "")
    assert whole.filter(back != F.col("t")).count() == 0  # the leaves behind one another are the paragraph
