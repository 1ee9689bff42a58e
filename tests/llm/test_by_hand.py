"""Operators 3, 4 and 6 and the pipeline against versions that do the same by hand."""

from __future__ import annotations

import math
import re

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from ledgerloom.llm import decontam, lines, quality, urls
from llm.conftest import prose
from llm.test_dedup import edits, lines_brute, sets_brute
from llm.test_rest import score_brute

# ---------------------------------------------------------------- decontamination


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_search_finds_what_full_alignment_finds(spark):
    """Every document aligned whole with every item, cell by cell."""
    rng = np.random.default_rng(8)
    items = [prose(i, int(rng.integers(8, 40))) for i in range(6)]
    docs = [prose(100 + i, int(rng.integers(5, 90))) for i in range(12)]
    for i in range(24):
        item = items[i % 6].split(" ")
        held = [w for w in item if rng.random() > 0.05]
        for _ in range(int(rng.integers(0, 4))):
            held.insert(int(rng.integers(0, len(held))), "inserted")
        docs.append(prose(200 + i, int(rng.integers(0, 60))) + " " + " ".join(held if i % 2 else edits(" ".join(held), rng, 3).split(" ")) + " " + prose(300 + i, int(rng.integers(0, 60))))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(frame, benchmark).collect()}
    number = {w: i for i, w in enumerate({w for t in [*docs, *items] for w in words_of(t)})}
    want = {}
    for i, item in enumerate(items):
        a = [number[w] for w in words_of(item)]
        for d, doc in enumerate(docs):
            score = score_brute(a, [number[w] for w in words_of(doc)]) / (2 * len(a))
            if score >= 0.5:
                want[d, i] = score
    assert len(want) >= 20
    assert got == pytest.approx(want)


# ---------------------------------------------------------------- urls


def test_each_rule_on_urls_that_it_matches(spark):
    """A url per alternative and ending of each rule, and some that miss it by a sign; all rules against all urls in SQL."""
    found = []
    for r in urls.PATTERN_RULES:
        path = re.sub(r"\(\?:([^|()]*)\|[^()]*\)", r"\1", r.pattern)
        tail = re.sub(r"\\z|\[\^[^\]]*\]\*|[\\?^$]", "", path).replace("[&]", "?").replace("[0-9]+", "12").replace("[0-9a-f]{8,}", "0123abcd").replace("[a-z]+", "xy").replace("[0-9]", "3")
        for head in ("http://q.io", "http://q.io/a?b=1"):
            found += [head + tail, head + tail + "\n", head + tail + "x", head + tail + "?z=1", head + tail + "#f"]
        for t in (*r.tokens, *(x for o in r.others for x in o)):
            found += [f"http://q.io/{t}", f"http://q.io/{t}/", f"http://q.io/a.{t}", f"http://{t}.q.io/x", f"http://q.io/x?{t}=1", f"http://q.io/{t}\n", f"HTTP://Q.IO/{t.upper()}", f"http://q.io/{t}?y"]
    found += ["http://q.io/a.zip\n", "http://q.io/signin?x", "http://q.io/" + "a/" * 50_000 + "login", "x" * 100_000, None, ""]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string").repartition(3)
    got = urls.filter_urls(pages, *urls.rule_frames(spark))
    c = duckdb.connect()
    c.sql("create table pages (page_id bigint, url varchar)")
    c.executemany("insert into pages values (?, ?)", list(enumerate(found)))
    want = c.sql(urls.oracle())
    rows = [tuple(r) for r in got.select(want.columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want.fetchall()))
    fired = {r[want.columns.index("pattern_rule")] for r in rows}
    assert len(fired) > 0.8 * len(urls.PATTERN_RULES)


# ---------------------------------------------------------------- quality


def test_weights_are_those_of_the_update_rule():
    """Follow the regularised leader feature by feature, in plain numbers."""
    rng = np.random.default_rng(2)
    rows = [(rng.integers(0, 30, int(rng.integers(0, 25))), int(rng.random() < 0.6)) for _ in range(40)]
    weights, bias = quality.follow_the_leader(rows, 5)
    z, n = dict.fromkeys(range(33), 0.0), dict.fromkeys(range(33), 0.0)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for numbers, label in rows:
            x = {32: 1.0}
            for i in numbers.tolist():
                x[i] = x.get(i, 0.0) + quality.SCALE / len(numbers)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    assert weights[:32] == pytest.approx([weight(i) for i in range(32)]) and bias == pytest.approx(weight(32))


def test_a_score_depends_on_the_text_alone():
    rng = np.random.default_rng(4)
    weights = rng.normal(size=1 << quality.BITS)
    text = prose(1, 70).encode()
    alone = quality.scores([text], weights, 0.1)[0]
    others = [prose(i, int(n)).encode() for i, n in enumerate(rng.integers(0, 300, 60))]
    for k in range(0, 60, 7):
        assert quality.scores([*others[:k], text, b"", *others[k:]], weights, 0.1)[k] == alone
    number, _ = quality.features([text])
    by_hand = 1 / (1 + math.exp(-(math.fsum(weights[number]) / len(number) * quality.SCALE + 0.1)))
    assert alone == pytest.approx(by_hand)
    assert quality.scores([b"", b""], weights, 0.1).tolist() == [1 / (1 + math.exp(-0.1))] * 2


# ---------------------------------------------------------------- pipeline


def test_lines_stage_by_hand(spark):
    block = [prose(i, 6) for i in range(12)]
    texts = ["\n".join(block[a:b]) for a, b in [(0, 6), (2, 8), (5, 6), (4, 7), (0, 12), (1, 5)]] + ["", " \n", "two words", "two words\nnew", None]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = lines_brute([(i, t) for i, t in enumerate(texts) if t is not None], lines.WINDOW, lines.LONG_WORDS)
    want = {i: t for i, t in want.items() if t.strip() or not texts[i].strip()} | {10: None}
    after = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert after.schema.simpleString() == docs.schema.simpleString()
    got = {r.doc_id: r for r in after.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text or "") for r in got.values())


def test_copies_stage_by_hand(spark):
    rng = np.random.default_rng(6)
    texts = [edits(prose(f, 90), rng, int(rng.integers(0, 8))) for f in range(5) for _ in range(6)] + ["", None, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {i for i, (n, c) in sets_brute(list(enumerate(texts))).items() if c == i}
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect()} == want


def test_quality_stage_by_hand(spark, tmp_path):
    good, bad = [prose(i, 60) for i in range(60)], [("zz%d " % (i % 7)) * 50 for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(x for p in zip(good, bad, strict=True) for x in p)], "doc_id long, text string").repartition(3)
    spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    scored = {r.row.doc_id: r.quality_score for r in quality.classify(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, s in scored.items() if s >= 0.5} == set(range(0, 120, 2))


def test_pipeline_of_nothing(spark, nothing, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
