"""Segmentation, observations, identity and layout on small hand-made editions and random ones."""

from __future__ import annotations

import random

from ledgerloom.functions import vocabulary as V
from ledgerloom.operators import identity, layout, ledger, mentions, segmentation, views
from ledgerloom.plans.edition import Edition, against_baseline, summary
from pyspark.sql import functions as F

BLOCKS = [
    # page, role, noise, text
    (1, "h2", False, "DIÁRIO OFICIAL DO DISTRITO FEDERAL"),
    (1, "paragraph", False, "Sumário"),
    (1, "h1", False, "SEÇÃO I"),
    (1, "h2", False, "SECRETARIA DE ESTADO DE ESPORTE"),
    (1, "h2", False, "E LAZER"),
    (1, "paragraph", False, "SUBSECRETARIA DE GESTÃO"),
    (1, "paragraph", False, "PORTARIA Nº 12/2026, DE 3 DE MARÇO DE 2026. Texto."),
    (1, "paragraph", False, "Art. 1º EXONERAR, A PEDIDO, FULANO DE TAL, Assessor, da Secretaria, no processo 00001-00000002/2026-03."),
    (1, "paragraph", True, "17"),
    (2, "paragraph", False, "CNPJ 33.595.865/0001-05 e 01.701.830/0001-32, R$ 1.234,50."),
    (2, "paragraph", False, "ELIANE RAMOS LTDA"),
    (2, "h1", False, "SEÇÃO III"),
    (2, "h1", False, "SEÇÃO II"),
    (2, "paragraph", False, "Texto sem título"),
    (2, "paragraph", False, "Processo 00001-00000002/2026-03 e FULANO DE TAL"),
    (2, "paragraph", False, "NOMEAR FULANO DE TAL, processo 5, x"),
]


def blocks(spark, rows=BLOCKS, doc=1):
    return spark.createDataFrame([(doc, p, i, f"p{p:04d}-b{i:04d}", t, r, n) for i, (p, r, n, t) in enumerate(rows)], "doc_id long, page int, ord int, block_id string, text string, role string, noise boolean").repartition(3)


def test_a_small_edition(spark):
    e = Edition(blocks(spark))
    category = [r.category for r in e.assigned.orderBy("n").collect()]
    item, context = "published_item", "editorial_context"
    assert category == ["summary", "summary", "section_heading", context, context, context, item, item, "noise", item, item, item, "section_heading", item, item, item]
    contexts = {r.context: (r.label, r.level, r.breadcrumb) for r in e.contexts.collect()}
    assert contexts == {1: ("SECRETARIA DE ESTADO DE ESPORTE E LAZER", 2, ["SECRETARIA DE ESTADO DE ESPORTE E LAZER"]), 2: ("SUBSECRETARIA DE GESTÃO", 3, ["SECRETARIA DE ESTADO DE ESPORTE E LAZER", "SUBSECRETARIA DE GESTÃO"])}
    items = {r.item: r for r in e.items.collect()}
    assert (items[1].title, items[1].item_type, items[1].number, items[1].act_date) == ("PORTARIA Nº 12/2026, DE 3 DE MARÇO DE 2026", "portaria", "12/2026", "2026-03-03")
    assert (items[1].start_page, items[1].end_page, items[2].item_type, items[2].section) == (1, 2, "unclassified", "II")
    people = {(r.entity_type, r.value_original) for r in e.entities.filter("entity_type <> 'organization'").collect()}
    assert people == {("person", "FULANO DE TAL"), ("position", "Assessor")}
    assert sorted((r.reference_type, r.valid) for r in e.references.collect()) == [("cnpj", False), ("cnpj", True), ("monetary_value", None), ("norm", None)]
    counts = identity.identity_counts(e.fragments).first()
    assert (counts.canonical_entities, counts.identity_links, counts.candidate_groups, counts.resolution_cases) == (2, 3, 1, 1)
    broken = views.evidence(e.references, e.blocks).filter("literal <> value_original")
    assert broken.count() == 0
    assert summary(e.blocks).first().asDict() == {"doc_id": 1, "pages": 2, "blocks": 16, "noise_blocks": 1, "mentions": 2, "distinct_values": 1, "orphans": 0}
    assert views.search(e.items.select("item", "title", "breadcrumb"), "esporté", ["title", "breadcrumb"]).count() == 1


def decide(rows):
    """The categories of one document, block by block, written as a loop over states."""
    import re

    title = re.compile(f"^({'|'.join(V.ITEM_TYPES)})\\b", re.I)
    organisation = re.compile(rf"\b({'|'.join(V.ORGANISATION_WORDS)})\b", re.I)

    def heading(b, free):
        p, role, noise, t = b
        if noise or not t or title.match(t) or t.startswith(V.NO_CONTEXT) or t != t.upper() or len(t) > 180:
            return False
        return role in ("h1", "h2") or (not re.search(r"\d", t) and bool(free or organisation.search(t)))

    def leads(i):
        for b in rows[i + 1 :]:
            if b[2] or b[3] == V.PUBLICATION_HEADER or b[3].startswith(V.IMPRINT):
                continue
            if title.match(b[3]):
                return True
            if not heading(b, True):
                return False
        return False

    out, state, page, expected, section = [], "none", None, 0, None
    for i, b in enumerate(rows):
        found = re.fullmatch(r"SEÇÃO\s+(I|II|III)", b[3], re.I)
        if b[2]:
            kind = "noise"
        elif found and expected < 3 and found[1].upper() == V.SECTIONS[expected]:
            kind, expected, section, state = "section_heading", expected + 1, found[1], "none"
        elif section is None:
            kind = "summary" if b[0] == 1 else "front_matter"
        elif b[3] == V.PUBLICATION_HEADER:
            kind = "publication_header"
        elif b[3].startswith(V.IMPRINT):
            kind = "publication_metadata"
        else:
            context = heading(b, state == "context" and page == b[0]) and (state != "item" or leads(i))
            kind = "editorial_context" if context else "published_item"
            if context and state != "context":
                page = b[0]
            elif context and not (page == b[0]):
                page = b[0]
            state = "context" if context else "item"
            out.append(kind)
            continue
        state = "item" if state == "item" else "none"
        out.append(kind)
    return out


def test_random_editions_against_a_loop(spark):
    rng = random.Random(3)
    texts = ["SEÇÃO I", "SEÇÃO II", "SEÇÃO III", "SECRETARIA DE OBRAS", "E LAZER", "NOME QUALQUER", "PORTARIA Nº 1", "Decreto 5", "Texto comum", "CAPÍTULO I", "ANEXO 7", V.PUBLICATION_HEADER, V.IMPRINT + " x", "12"]
    documents, rows = {}, []
    for d in range(300):
        page, doc = 1, []
        for _ in range(rng.randrange(1, 30)):
            page += rng.random() < 0.1
            doc.append((page, rng.choice(["h1", "h2", "h3", "paragraph"]), rng.random() < 0.08, rng.choice(texts)))
        documents[d] = decide(doc)
        rows += [(d, p, i, f"b{i}", t, r, n) for i, (p, r, n, t) in enumerate(doc)]
    frame = spark.createDataFrame(rows, "doc_id long, page int, ord int, block_id string, text string, role string, noise boolean").repartition(5)
    found: dict = {}
    for r in segmentation.assign(frame).orderBy("doc_id", "n").collect():
        found.setdefault(r.doc_id, []).append(r.category)
    assert found == documents


def reading_order(rows, width):
    """Order of one page's boxes (source, x0, y0, x1, y1), band by band."""
    wide = [b for b in rows if b[3] - b[1] >= width * 0.62]
    rest = [b for b in rows if b not in wide]
    if not rest:
        return [b[0] for b in sorted(wide, key=lambda b: (b[2], b[1]))]

    def columns(bs):
        left = [b for b in bs if (b[1] + b[3]) / 2 < width / 2]
        return sorted(left, key=lambda b: (b[2], b[1])) + sorted([b for b in bs if b not in left], key=lambda b: (b[2], b[1]))

    out = []
    for w in sorted(wide, key=lambda b: b[2]):
        above = [b for b in rest if b[4] <= w[2]]
        out += [*columns(above), w]
        rest = [b for b in rest if b not in above]
    return [b[0] for b in [*out, *columns(rest)]]


def test_reading_order_against_bands(spark):
    rng = random.Random(4)
    want, rows = {}, []
    for page in range(200):
        boxes = []
        for k in range(rng.randrange(1, 12)):
            x0 = rng.choice([40, 50, 310])
            y0 = rng.randrange(0, 12) * 10.0
            boxes.append((k, float(x0), y0, float(rng.choice([x0 + 200, 560])), y0 + rng.randrange(1, 40)))
        want[page] = reading_order(boxes, 600)
        rows += [(1, page, *b, "t", 10.0, False) for b in boxes]
    frame = spark.createDataFrame(rows, "doc_id long, page int, source_order int, x0 double, y0 double, x1 double, y1 double, text string, font_size double, bold boolean")
    pages = spark.createDataFrame([(1, p, 600.0, 800.0) for p in want], "doc_id long, page int, width double, height double")
    got: dict = {}
    for r in layout.enrich(frame, pages).orderBy("page", "ord").collect():
        got.setdefault(r.page, []).append(r.source_order)
    assert got == want


def test_mention_without_block_fails(spark):
    e = Edition(blocks(spark))
    lost = e.blocks.filter("ord <> 7")
    assert mentions.orphans(e.mentions, lost).count() == 1
    try:
        mentions.with_block(e.mentions, lost, "role").collect()
        raise AssertionError("no error")
    except Exception as error:
        assert "no block" in str(error)


def test_ledger(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, version int")
    new = spark.createDataFrame([(1, "c", 1), (2, "d", 4), (3, "e", 1)], "k int, v string, version int")
    assert sorted(map(tuple, ledger.upsert(old, new, ["k"], ["version"]).collect())) == [(1, "c", 1), (2, "b", 5), (3, "e", 1)]
    once = ledger.replace_by_run(old, new, "k")
    assert ledger.unlike(once, ledger.replace_by_run(once, new, "k")).count() == 0
    checks = ledger.violations(old, {"small": F.col("version") < 3, "null": F.lit(None).cast("boolean")})
    assert {r.constraint_name: r.violations for r in checks.collect()} == {"small": 1, "null": 2}
    runs = spark.createDataFrame([("r1", ["a"], ["b"]), ("r2", ["b"], ["c", "d"])], "run_key string, inputs array<string>, outputs array<string>")
    found = {(r.artifact, r.ancestor, r.depth) for r in ledger.ancestry(ledger.lineage_edges(runs)).collect()}
    assert found == {("b", "a", 1), ("c", "b", 1), ("d", "b", 1), ("c", "a", 2), ("d", "a", 2)}
    loop = spark.createDataFrame([("r1", ["a"], ["b"]), ("r2", ["b"], ["a"])], "run_key string, inputs array<string>, outputs array<string>")
    assert ledger.ancestry(ledger.lineage_edges(loop)).count() == 4
    assert [tuple(r) for r in against_baseline(spark.createDataFrame([(1, 5)], "k int, n int"), spark.createDataFrame([(1, 6)], "k int, n int"), ["k"]).collect()] == [(1, "n", 5, 6)]
