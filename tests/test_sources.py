"""Files in and out, contracts, annotation rules and the landing stream."""

from __future__ import annotations

import hashlib
import json

import pytest
from ledgerloom.functions.spans import Rule
from ledgerloom.operators import annotation
from ledgerloom.sources import documents as D
from ledgerloom.streaming import landing


def test_manifests_and_structured_documents(spark, tmp_path):
    doc = {"schema_version": "1.0", "source": {"sha256": "s1", "filename": "x.pdf", "page_count": 1}, "pages": [{"number": 1, "width": 600.0, "height": 800.0, "rotation": 0, "blocks": [{"id": "p0001-b0001", "page": 1, "order": 1, "text_normalized": " a ", "markdown_role": "h1", "removed_as_noise": False}, {"id": "p0001-b0002", "page": 1, "order": 2}]}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text(json.dumps(doc))
    structured = D.read_structured(spark, str(tmp_path / "in"))
    rows = sorted(map(tuple, D.flatten(structured).collect()))
    assert rows == [("s1", 1, 1, "p0001-b0001", "a", "h1", False), ("s1", 1, 2, "p0001-b0002", "", "paragraph", False)]
    assert D.page_metadata(structured).columns == ["doc_id", "number", "width", "height", "rotation"]
    m = D.manifests(spark, str(tmp_path / "in")).first()
    data = (tmp_path / "in/x.json").read_bytes()
    assert (m.filename, m.size_bytes, m.sha256, m.media_type) == ("x.json", len(data), hashlib.sha256(data).hexdigest(), "application/json")
    D.write_bundle(D.flatten(structured), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    (tmp_path / "in/bad.json").write_text('{"pages": 5}')
    with pytest.raises(Exception, match="MALFORMED"):
        D.read_structured(spark, str(tmp_path / "in")).collect()


def batch(mode, records, **more):
    base = {"batch_id": "b", "mode": mode, "automatic_artifacts": [], "document_sha256": "d", "page_count": 2, "pages": [1, 2]} | more
    return (*base.values(), records)


def record(**more):
    base = {"id": "r", "annotation_type": "observation", "task_type": "reference", "judgment": "PRESENT", "target": None, "rationale": None, "error_categories": [], "fragment_ids": [], "evidence": [("d", 1, 0, 4)]}
    return tuple((base | more).values())


@pytest.mark.parametrize(
    "made,rules",
    [
        (batch("blind_primary", [record()]), set()),
        (batch("blind_primary", [record(target="t")]), {"independent_only_observes"}),
        (batch("independent_second", [], automatic_artifacts=["a"]), {"automatic_input"}),
        (batch("assisted_review", [record(annotation_type="evaluation", judgment="REJECTED", target="t", rationale="w")]), {"error_category_missing"}),
        (batch("assisted_review", [record(annotation_type="identity_decision", task_type="identity_resolution", judgment="SAME_ENTITY", rationale="w", fragment_ids=["f"])]), {"identity_incomplete"}),
        (batch("adjudication", [record(annotation_type="adjudication", judgment="UNRESOLVED")]), {"rationale_missing"}),
        (batch("blind_primary", [record(evidence=[("x", 3, 5, None)])], pages=[1, 3]), {"scope_beyond_document", "evidence_of_other_document", "evidence_span"}),
        (batch("blind_primary", [record(), record(judgment="SAME_ENTITY", rationale="w")]), {"repeated_id", "judgment_of_type"}),
    ],
)
def test_annotation_rules(spark, made, rules):
    assert {r.rule for r in annotation.violations(spark.createDataFrame([made], annotation.BATCH)).collect()} == rules


def test_landing_stream(spark, tmp_path):
    rows = [(1, "a 1.2.3.4"), (2, "none"), (3, "a 1.2.3.4")]
    for i in range(2):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    arrived = landing.arrivals(spark, f"{tmp_path}/in/*", "doc_id long, text string")
    found = landing.mention_stream(arrived, D.text_blocks, [Rule("ip", r"\d+\.\d+\.\d+\.\d+")])
    landing.into_table(found, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
