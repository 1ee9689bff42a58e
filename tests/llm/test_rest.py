"""Operators 3, 4, 5, 6, 10 and the pipeline."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import pytest
from ledgerloom.llm import chat, decontam, merkle, quality, urls
from llm.conftest import prose

# ---------------------------------------------------------------- decontamination


def score_brute(item, text):
    """Smith-Waterman cell by cell."""
    h = np.zeros((len(item) + 1, len(text) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(0)
    items = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(40)]
    texts = [rng.integers(0, 6, rng.integers(0, 40)) for _ in range(40)]
    assert decontam.align(items, texts).tolist() == [score_brute(a.tolist(), b.tolist()) for a, b in zip(items, texts, strict=True)]


@pytest.mark.parametrize("block", [10**6, 60])
def test_copies_edited_copies_and_clean_documents(spark, block):
    rng = np.random.default_rng(1)
    items = [prose(i, 40) for i in range(8)] + ["tiny item", "", None]
    docs = []
    for i, item in enumerate(items[:8]):
        words = item.split(" ")
        edited = [w for w in words if rng.random() > 0.06]
        for _ in range(4):
            edited[rng.integers(len(edited))] = "new"
        docs += [prose(100 + i, 50) + " " + item.upper() + " " + prose(200 + i, 300), prose(300 + i, 20) + "\n" + " ".join(edited), prose(400 + i, 500), " ".join(words[:6]) + " " + prose(500 + i, 80)]
    docs += ["a tiny item, here", None, "", prose(3, 40)]
    benchmark = spark.createDataFrame([*enumerate(items), (None, "null id")], "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(frame, benchmark, block=block).collect()}
    assert got == {(4 * i + k, i) for i in range(8) for k in (0, 1)} | {(32, 8), (35, 3)}
    assert decontam.decontaminate(frame, benchmark).count() == len(docs) - 18


def test_decontamination_of_awkward_rows(spark, awkward, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, prose(4, 60)), (1, prose(4, 60))], "item_id long, text string")
    assert decontam.contaminated(awkward, none).count() == 0
    assert [tuple(r)[:2] for r in decontam.contaminated(awkward, some).collect()] == [(None, 1)]
    left = decontam.decontaminate(awkward, some)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 1  # the other row without a doc_id stays
    assert decontam.decontaminate(nothing, some).count() == 0


# ---------------------------------------------------------------- urls


def test_urls_against_sql(spark):
    found = ["http://a.net/x", "HTTPS://EXAMPLE.NET/en/1?utm_source=feed", "https://x.example.net/en", "http://example.com/de/?page=1&ref=x", "ftp://org/fr/", "http://notnet/", "x.net/y", None, "", "://net/", "http://net", "http://blog.q.io/en/12.html", "http://m.q.io/a?page=3", "http://q.io/login?x", "http://q.io/a.zip", "http://Ünet/İ", "http://a.net/x"]
    pages = spark.createDataFrame([(i // 2, u, "h", "v") for i, u in enumerate(found)], "page_id long, url string, rule string, verdict string")
    got = sorted(map(str, urls.filter_urls(pages, *urls.rule_frames(spark)).select("host", "page_id", "path", "pattern_rule", "rule", "verdict").toPandas().astype(object).where(lambda d: d.notna(), None).values.tolist()))
    c = duckdb.connect()
    c.execute("create table pages (page_id bigint, url varchar)")
    c.executemany("insert into pages values (?, ?)", [(i // 2, u) for i, u in enumerate(found)])
    want = sorted(map(str, (list(r) for r in c.execute(f"select host, page_id, path, pattern_rule, rule, verdict from ({urls.oracle()})").fetchall())))
    assert got == want
    assert urls.filter_urls(pages.filter("false"), *urls.rule_frames(spark)).count() == 0


def test_index_is_the_rarest_token(spark):
    pages = spark.createDataFrame([("http://a/b?c=1",), ("http://a/b",), ("http://a/",)], "url string")
    rows = pages.select("url", urls.url_tokens(pages.url).alias("tokens"))
    rules = spark.createDataFrame([("r", "b\\?c=", ["b", "c"]), ("s", "zz", ["zz", "a"])], "name string, pattern string, tokens array<string>")
    assert {r.name: r.token for r in urls.indexed(rows, rules).collect()} == {"r": "c", "s": "zz"}


# ---------------------------------------------------------------- chat


def test_chats_read_back(spark):
    said = ["\\### Assistant: </turn> ok", "\\h\\\\l#<", "", None, "</turn>\n### User: x", "###" * 3 + "<|image:1|>", "é🙂\n"]
    roles = ["user", "assistant", "system", "tool: \\r#<x", None, "Assistant", "assistant"]
    rows = [(c, t if c != 3 else None, roles[(t + (c or 0)) % 7], said[(t * 3 + (c or 0)) % 7]) for c in (0, 1, 2, 3, None) for t in range(7)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_chats(chat.text_messages(frame))
    back = chat.read_back(made).collect()
    for c in (0, 1, 2, None):
        want = [(r or "", x or "") for k, t, r, x in rows if k == c]
        own = sorted((r for r in back if r.conv_id == c), key=lambda r: r.ord)
        assert [(r.role, r.text) for r in own] == want
        assert [r.in_loss for r in own] == [x if r == "assistant" else None for r, x in want]
    digest = {r.conv_id: r for r in chat.digests(made).collect()}
    want = [(r or "", x or "") for k, t, r, x in rows if k == 1]
    assert digest[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in want).encode()).hexdigest()
    assert digest[1].loss_chars == sum(len(x) for r, x in want if r == "assistant")
    assert len(digest) == 5 and digest[3].n_turns == 7
    assert chat.digests(chat.format_chats(chat.text_messages(frame.filter("false")))).count() == 0


def test_parts_become_placeholders(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "look <"), part("image", ref="a.png", w=57, h=28), part("text", "|image:9|> and"), part("audio", ref="b.wav", s=2.0)]),
        (1, 1, "assistant", [part("document", ref="c.pdf", p=3), part(None, "read")]),
        (2, 0, "user", None),
    ]
    made = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).collect()}
    assert made[1].formatted == "### User: look \\l<|image:1|>|image:9|> and<|audio:2|></turn>\n### Assistant: <|document:3|>read</turn>\n"
    assert [tuple(a) for a in made[1].attachments] == [(1, "image", "a.png", 3), (2, "audio", "b.wav", 25), (3, "document", "c.pdf", 768)]
    assert made[1].attachment_tokens == 796 and made[2].attachments == [] and made[2].formatted == "### User: </turn>\n"
    start, length = made[1].loss[0]
    assert made[1].formatted[start : start + length] == "<|document:3|>read"


# ---------------------------------------------------------------- quality


def test_the_classifier_learns_and_holds_out(spark):
    rows = [(i, prose(i, 60) if i % 3 else " ".join(["junk!!"] * 30) + prose(i, 10).upper()) for i in range(300)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, quality_score string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == 300
    held = [r for r in found if r.held_out]
    assert 50 < len(held) < 150
    assert np.mean([(r.quality_score >= 0.5) == (r.row.doc_id % 3 > 0) for r in held]) > 0.95
    # held-out labels change nothing
    other = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    assert {r.row.doc_id: r.quality_score for r in quality.classify(docs, other).collect()} == {r.row.doc_id: r.quality_score for r in found}


def test_scores_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 15)], "doc_id long, quality int, toxic int")
    found = quality.classify(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.quality_score <= 1 for r in found)
    assert quality.classify(nothing, labels).count() == 0
    assert {r.quality_score for r in quality.classify(awkward, labels.filter("false")).collect()} == {0.5}


# ---------------------------------------------------------------- fingerprints


def test_fingerprints_follow_texts(spark, awkward, nothing):
    rows = merkle.compare_fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    source = sorted(((r.doc_id if r.doc_id is not None else -(2**63), r.text or "") for r in awkward.collect()), key=lambda x: (-x[0], x[1]))
    by = {}
    for k, (i, text) in enumerate(source):
        other = source[(k + 1) % len(source)][1]
        n = len(text) // 3
        by.setdefault((i, len(text)), set()).add(hashlib.sha256((text[: len(text) - n] + other[:n]).encode()).hexdigest())
    assert all(r.edited_sha256 in by[(r.doc_id if r.doc_id is not None else -(2**63), r.n_chars)] for r in rows)
    marks = {r.doc_id: r.fingerprint for r in rows if r.doc_id}
    assert marks[7] == marks[8] != marks[9] and marks[1] == marks[2]
    assert next(r for r in rows if r.doc_id == 6).near_edited > 0.6
    assert merkle.compare_fingerprints(nothing).count() == 0
    assert merkle.compare_fingerprints(awkward.filter("doc_id = 6")).first().near_next == 1.0


def test_branches_locate_edits(spark):
    a, b = "one\ntwo\n\nthree\nfour\n\nfive", "one\ntwo\n\nthree\n4\n\nfive\nsix"
    row = spark.createDataFrame([(a, b)], "a string, b string")
    found = row.select(merkle.differing(merkle.tree(row.a), merkle.tree(row.b)).alias("d")).first().d
    assert [tuple(x) for x in found] == [(1, 1), (2, 1)]


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, awkward, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 15)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(5, 80))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        assert [(f.name, f.dataType) for f in after.schema.fields] == [(f.name, f.dataType) for f in docs.schema.fields], name
        docs = after
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(rows) <= awkward.count()
    left = corpus_pipeline.drop_repeated_lines(spark, awkward, str(tmp_path))
    assert {(r.text is None or r.n_chars == len(r.text)) for r in left.collect()} == {True}
