"""Operator 1 removes every repeated line, short ones and ones with other neighbours too."""

from __future__ import annotations

from ledgerloom.llm import lines


def test_single_lines_go(spark):
    texts = ["Share this page\none\nShare this page", "two\nShare this page\n\nthree", "Yes.\n \nfour", "five\nYes.\n\nShare this page"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.row.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(docs).collect()}
    assert got == {0: ("Share this page\none", 1), 1: ("two\n\nthree", 1), 2: ("Yes.\n \nfour", 0), 3: ("five\n", 2)}
