"""Contracts, structured JSON, bundles, ids and caps on small rows."""

from __future__ import annotations

import json

import pytest
from ledgerloom.functions import text as T
from ledgerloom.operators import identity, ledger, views
from ledgerloom.plans.edition import dry_run
from ledgerloom.sources import contracts
from ledgerloom.sources import documents as D
from ledgerloom.streaming import landing
from pyspark.sql import functions as F

SOUND = {"path": "a/b.pdf", "filename": "b.pdf", "size_bytes": 3, "sha256": "0" * 64, "media_type": "application/pdf", "page_count": 1}
MANIFEST = "k int, path string, filename string, size_bytes long, sha256 string, media_type string, page_count int"


def test_first_broken_path_of_a_manifest(spark):
    changed = [{}, {"sha256": "0" * 63 + "G"}, {"size_bytes": 0, "sha256": "x"}, {"media_type": None}, {"filename": "", "path": ""}]
    rows = spark.createDataFrame([(i, *(({**SOUND, **c})[k] for k in SOUND)) for i, c in enumerate(changed)], MANIFEST)
    rows = rows.select("k", "path", "filename", "size_bytes", "sha256", "media_type", "page_count")
    found = {r.k: (r.path, r.message) for r in contracts.check(rows.withColumnRenamed("k", "k"), "manifest", ["k"]).collect()}
    assert {k: p for k, (p, _) in found.items()} == {1: "document.sha256", 2: "document.sha256", 3: "document.media_type", 4: "document.filename"}
    assert found[1][1] == "Contrato 'manifest' inválido em document.sha256"


def test_blocks_and_mentions_have_contracts(spark):
    box = F.array(*[F.lit(1.0)] * 4)
    rows = spark.range(3).select(
        "id", F.lit(1).alias("page"), F.lit(1).alias("order"), F.lit(1).alias("source_order"), F.lit(0).alias("column"), F.when(F.col("id") == 1, F.array(F.lit(1.0), F.lit(None), F.lit(1.0), F.lit(1.0))).otherwise(box).alias("bbox"),
        F.lit("x").alias("text_original"), F.lit("x").alias("text_normalized"), F.lit(1.0).alias("font_size"), F.lit(True).alias("bold"), F.lit("h1").alias("markdown_role"), F.lit(False).alias("removed_as_noise"),
    )
    rows = rows.withColumn("k", F.col("id")).withColumn("id", F.when(F.col("k") == 2, "p1-b1").otherwise("p0001-b0001"))
    assert {r.k: r.path for r in contracts.check(rows, "block", ["k"]).collect()} == {1: "blocks.bbox", 2: "blocks.id"}
    assert set(contracts.CONTRACTS) == {"manifest", "page", "block", "mention"}


def test_structured_text_that_does_not_fit_fails(spark):
    good = json.dumps({"source": {"sha256": "d"}, "pages": [{"number": 2, "blocks": [{"id": "b", "order": 1, "text_normalized": " x "}]}]})
    rows = D.flatten(D.parse_structured(spark.createDataFrame([(good,)], "value string"))).collect()
    assert [(r.doc_id, r.page, r.block_id, r.text, r.role, r.noise) for r in rows] == [("d", 2, "b", "x", "paragraph", False)]
    with pytest.raises(Exception, match="(?i)malformed"):
        D.flatten(D.parse_structured(spark.createDataFrame([('{"pages": 3',)], "value string"))).collect()


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    D.write_pretty(rows, f"{tmp_path}/p")
    text = spark.read.text(f"{tmp_path}/p", wholetext=True).first().value
    assert json.loads(text) == {"a": 1, "b": None, "c": "é"} and "\n" in text.strip()
    made = D.bundles({"x": spark.createDataFrame([(1, 2), (1, 1), (2, 3)], "doc_id int, v int"), "y": spark.createDataFrame([(1, "q")], "doc_id int, w string")})
    assert {r.doc_id: json.loads(r.bundle) for r in made.collect()} == {1: {"x": [{"v": 1}, {"v": 2}], "y": [{"w": "q"}]}, 2: {"x": [{"v": 3}], "y": []}}


def test_stamps_boxes_caps_and_guards(spark):
    row = spark.sql("select timestamp '2026-06-22 10:11:12.345678 UTC' as t")
    assert row.select(T.utc_stamp(row.t).alias("x")).first().x == "2026-06-22T10:11:12+00:00"
    assert row.select(T.utc_stamp(row.t, True).alias("x")).first().x == "2026-06-22T10:11:12.345678+00:00"
    boxes = spark.createDataFrame([([1.0] * 4,), ([1.0] * 3,), (None,)], "bbox array<double>")
    assert ledger.violations(boxes, {"four": ledger.is_box("bbox")}).first().violations == 2
    rows = spark.range(40).select((F.col("id") % 2).alias("g"), "id")
    first = views.first_per_group(rows, ["g"], ["id"], 12, "place").collect()
    assert len(first) == 24 and {r.place for r in first} == set(range(1, 13))
    a, b = (spark.createDataFrame([(1, h)], "doc_id int, sha256 string") for h in "xy")
    assert identity.same_document(a, a).count() == 1
    with pytest.raises(Exception, match="different documents"):
        identity.same_document(a, b).collect()


def test_dry_run_counts_missing_blocks_once(spark):
    manifest = spark.createDataFrame([(1, "x/DODF 112 22-06-2026 INTEGRA.pdf", "h"), (2, "loose.pdf", "i")], "doc_id int, filename string, sha256 string")
    blocks = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a")], "doc_id int, page int, block_id string")
    found = spark.createDataFrame([(1, "a"), (1, "z"), (1, "z")], "doc_id int, block_id string")
    rows = {r.doc_id: tuple(r)[1:] for r in dry_run(manifest, blocks, found).collect()}
    assert rows == {1: ("dodf:2026-06-22:edicao-112:integra", "h", 2, 2, 3, 1), 2: ("dodf:loose", "i", 1, 1, 0, 0)}


def test_latest_keeps_the_last_batch_of_a_document(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 1, 0), ("a", 3, 2)], "sha256 string, v int, batch int")
    assert sorted((r.sha256, r.v) for r in landing.latest(rows, ["sha256"]).collect()) == [("a", 3), ("b", 1)]
