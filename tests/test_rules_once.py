"""SQL rules compile no pattern for a row, and the query over them stores only what it reads."""

from __future__ import annotations

import re

from ledgerloom.functions import rules
from ledgerloom.functions.spans import CHUNK, FEW, Rule
from ledgerloom.queries import gazette

SF = "/root/testdata/sf0.001"


def test_sql_rules_split_no_text_and_keep_their_places(spark):
    texts = ["", "xab ab", "ab", "\U0001f600 ab \U0001f600 xab ab cab", "ab " * (FEW + 3), "ab cd " * CHUNK, "xab ab ab", "ab\nab", "cd ab", "no"]
    rules.register(spark, [Rule("once", r"(?U)\b(?:ab|cd)\b")])
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = spark.sql("select b.i, m.start, m.end, m.value from {rows} b, lateral find_once(b.text) m", rows=rows)
    assert "split(" not in found._jdf.queryExecution().toString()
    want = [(i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in re.finditer(r"\b(?:ab|cd)\b", t)]
    assert sorted(map(tuple, found.collect())) == want


def test_rules_read_a_table_of_texts_only(spark, monkeypatch):
    stored, real = [], gazette.checkpointed
    monkeypatch.setattr(gazette, "checkpointed", lambda df: stored.append(df.columns) or real(df))
    gazette.QUERIES["rules_in_sql"](spark, SF)
    assert stored == [["doc_id", "block_id", "text"]]
