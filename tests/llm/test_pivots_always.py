"""Operator 9 goes through pivots and cells whatever the size of the input."""

from __future__ import annotations

from ledgerloom.llm import jaccard
from llm.conftest import prose


def test_every_region_is_cut_by_pivots(spark, monkeypatch):
    cut_regions: list[int] = []
    plain = jaccard.voronoi

    def counted(sets, large, cell, elements, level):
        cut_regions.append(large.count())
        return plain(sets, large, cell, elements, level)

    monkeypatch.setattr(jaccard, "voronoi", counted)
    docs = []
    for i in range(4):
        words = prose(i, 120).split(" ")
        docs += [(100 * i + k, " ".join([*words[:k], "edited", *words[k + 1 :]])) for k in range(3 + i)]
    docs += [(900 + i, prose(50 + i, 80)) for i in range(5)] + [(950, "two words"), (951, None)]
    found = jaccard.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(d, d // 100 * 100 if d < 900 else d) for d, _ in docs}
    assert cut_regions == [4]
