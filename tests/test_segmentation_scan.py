"""Segmentation in windows against a loop that goes from block to block, and on one very long document."""

from __future__ import annotations

import random

from ledgerloom.functions import vocabulary as V
from ledgerloom.operators import segmentation
from pyspark.sql import functions as F

TEXTS = ["SEÇÃO I", "SEÇÃO II", "SEÇÃO III", "SECRETARIA DE OBRAS", "E LAZER", "NOME QUALQUER", "A", "X" * 90, "Y" * 178, "PORTARIA Nº 1", "Decreto 5", "Texto comum", "CAPÍTULO I", "ANEXO 7", V.PUBLICATION_HEADER, V.IMPRINT + " x", "12", ""]
KIND = "doc_id long, page int, ord int, block_id string, text string, role string, noise boolean"


def walk(rows):
    """(context, item, begins, breadcrumb) of each row of flags, one after another."""
    out, item, after, page, level, label, crumb, contexts, items = [], False, False, None, 0, "", [], 0, 0
    for r in rows:
        section = r.section is not None
        plain = not (r.noise or r.opens or not section or r.header or r.imprint)
        if not plain:
            if r.opens and not r.noise:
                item, crumb = False, []
            after = False
            out.append((0, 0, False, None))
            continue
        joins = after and page == r.page
        after = (r.more if joins else r.start) and (r.leads or not item)
        if not after:
            begins = r.title or not item
            items, item = items + begins, True
            out.append((0, items, begins, crumb if begins else None))
            continue
        item, depth = False, {"h1": 1, "h2": 2}.get(r.role, 3)
        named = any(w in r.text for w in V.ORGANISATION_WORDS)
        if joins and depth == level and not named and len(label) + 1 + len(r.text) <= 180:
            label = f"{label} {r.text}"
            crumb = [*crumb[:-1], label]
        else:
            contexts, level, label, page = contexts + 1, depth, r.text, r.page
            crumb = [*crumb[: depth - 1], r.text]
        out.append((contexts, 0, False, crumb))
    return out


def test_contexts_items_and_breadcrumbs_against_a_loop(spark):
    rng = random.Random(11)
    rows = []
    for d in range(400):
        page, heads = 1, rng.random()
        for i in range(rng.randrange(1, 40)):
            page += rng.random() < 0.08
            text = rng.choice(TEXTS[3:9]) if rng.random() < heads else rng.choice(TEXTS)
            rows.append((d, page, i, f"b{i:03d}", text, rng.choice(["h1", "h2", "h3", "paragraph"]), rng.random() < 0.06))
        if d % 2:
            rows.append((d, 0, 0, "b0", "SEÇÃO I", "h1", False))
    frame = spark.createDataFrame(rows, KIND).repartition(5)
    seen: dict = {}
    for r in segmentation.flags(frame).orderBy("doc_id", "n").collect():
        seen.setdefault(r.doc_id, []).append(r)
    want = {d: walk(r) for d, r in seen.items()}
    got: dict = {}
    for r in segmentation.assign(frame).orderBy("doc_id", "n").collect():
        got.setdefault(r.doc_id, []).append((r.context, r.item, r.begins, r.breadcrumb))
    assert got == want
    found = [c for rows_ in want.values() for _, _, _, c in rows_ if c]
    assert any(len(c) == 3 for c in found) and any(len(x) > 170 for c in found for x in c)


def test_a_document_of_a_million_blocks(spark):
    """One document in one sorted stream, without Python workers; what the first and last blocks are doesn't depend on its length."""
    n = 1_000_000
    text = F.expr("case when id = 0 then 'SEÇÃO I' when id % 1000 = 1 then 'SECRETARIA DE OBRAS' when id % 1000 = 2 then 'PORTARIA Nº 1' else 'Texto comum' end")
    rows = spark.range(0, n, 1, 4).select(F.lit(1).cast("long").alias("doc_id"), (F.col("id") / 30).cast("int").alias("page"), F.col("id").cast("int").alias("ord"), F.format_string("b%07d", "id").alias("block_id"), text.alias("text"), F.lit("h2").alias("role"), F.lit(False).alias("noise"))
    found = segmentation.assign(rows)
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
    got = found.groupBy("category").agg(F.count("*").alias("n"), F.max("item").alias("items"), F.max("context").alias("contexts")).collect()
    assert {r.category: (r.n, r.items, r.contexts) for r in got} == {"section_heading": (1, 0, 0), "editorial_context": (1000, 0, 1000), "published_item": (n - 1001, 1000, 0)}
