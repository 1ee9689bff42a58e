"""Work that follows the input: spans, partitions of blocks, what is stored."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerloom.functions.spans import FEW, spans
from ledgerloom.plans import edition, gazette
from ledgerloom.queries.gazette import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_spans_compile_no_pattern_for_a_row_and_keep_their_places(spark):
    texts = ["", "xab ab", "ab", "\U0001f600 ab \U0001f600 xab ab cab", "ab " * (FEW + 3), "xab ab ab", "ab\nab", "no"]
    pattern = r"(?U)\bab\b"
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", "text", spans(F.col("text"), pattern).alias("s"))
    assert "split(" not in _plan(rows)
    for r in rows.collect():
        assert [(s["start"], s["end"], s["value"]) for s in r["s"]] == [(m.start(), m.end(), m.group()) for m in re.finditer(r"\bab\b", r["text"])]


def test_blocks_are_dealt_over_tasks_by_the_number_of_orders(spark, monkeypatch):
    monkeypatch.setattr(gazette, "TASK", 100)
    assert gazette.blocks(spark, SF).rdd.getNumPartitions() >= 15


def test_matches_are_stored_only_where_they_are_read_again(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(edition, "checkpointed", lambda df: stored.append(df.columns) or df)
    QUERIES["view_process_items"](spark, SF)
    assert len(stored) == 1
