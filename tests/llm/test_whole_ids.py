"""Rows without a doc_id, or with one id and unlike texts, are documents of their own in operators 1 and 2."""

from __future__ import annotations

import pytest
from ledgerloom.llm import lines, suffix
from llm.conftest import prose

A, B, C = (prose(60 + i, 60).replace("\n", " ") for i in range(3))
TEXTS = [A + "\n" + B, A + "\n" + C, "only here\n" + A, C]


@pytest.mark.parametrize("doc_id", [None, 5])
def test_unlike_rows_are_documents(spark, doc_id):
    rows = [(doc_id, t) for t in TEXTS] + [(9, B)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lines.dedup_lines(docs).collect()
    left = [x for r in got for x in r.text.split("\n") if x]
    assert sorted(left) == sorted([A, B, C, "only here"])  # each once, nothing unique lost
    rows = suffix.dedup_bytes(docs).collect()
    kept = b"|".join(bytes(r.kept) for r in rows)
    assert len(rows) == 5 and all(kept.count(x.encode()[:100]) == 1 for x in (A, B, C)) and kept.count(b"only here") == 1


def test_copies_without_id_go(spark):
    docs = spark.createDataFrame([(None, A), (None, A), (None, A), (3, B)], "doc_id long, text string").repartition(3)
    assert sorted(r.text for r in lines.dedup_lines(docs).collect()) == sorted([A, "", "", B])
    assert sorted(bytes(r.kept) for r in suffix.dedup_bytes(docs).collect()) == sorted([A.encode(), b"", b"", B.encode()])
