"""Operators 11, 12 and 13 against brute-force versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from ledgerloom.llm import manifest, phrases, topk
from llm.conftest import prose
from pyspark.sql import functions as F

# ---------------------------------------------------------------- dataset manifest


def sha(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(row, lower=False):
    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes):
    """The root, and of every leaf its (left, right) siblings, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_, i in enumerate(at):
            run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
            paths[leaf_].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes, at = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], paths


def manifest_brute(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in sources:
        mine = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = (mine, *tree([leaf(r) for r in mine]))
    root, above = tree([trees[s][1] for s in sources])
    for s, up in zip(sources, above, strict=True):
        mine, subroot, paths = trees[s]
        for r, path in zip(mine, paths, strict=True):
            path = path + up
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node = leaf(r, tampered)
            for a, b in path:
                node = sha(a, node, b)
            out.append((r["doc_id"], leaf(r), subroot, root, sha(*[a + b for a, b in path]), node, node == root))
    return sorted(map(repr, out))


def test_manifest(spark, awkward, nothing):
    named = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for sizes in ({"a": 700, "b": 1, None: 17, "é": 16, "": 257}, {"a": 3}, {f"s{i}": 1 + i % 3 for i in range(40)}):
        rows = [(i, s, None if i % 7 == 0 else "en", i % 50, None if i % 11 == 0 else f"Text {i}\nÉ Z") for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
        got = manifest.verify(docs).select(named)
        assert sorted(repr(tuple(r)) for r in got.collect()) == manifest_brute([r.asDict() for r in docs.collect()])
    got = sorted(repr(tuple(r)) for r in manifest.verify(awkward).select(named).collect())
    assert got == manifest_brute([r.asDict() for r in awkward.collect()])
    assert manifest.verify(nothing).count() == 0


# ---------------------------------------------------------------- top-k search


def top_brute(rows, asked, k=5):
    """rows: (id, vector); the rows of either side are told apart by position."""
    real = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            real.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (q, x) in enumerate(real):
        if asked(q):
            scores = [(-sum(s * t for s, t in zip(x, y)), i is None, i or 0, i) for b, (i, y) in enumerate(real) if a != b]
            out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda t: t[:3])[:k])]
    return sorted(map(repr, out))


@pytest.mark.parametrize("block", [8192, 16])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 3 if block == 16 else 2048)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8)) * 4
    vectors = [[float(x) for x in (centres[i % 6] + rng.normal(size=8) * 0.1).astype(np.float32)] for i in range(400)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[10]) for i in range(150)]  # one vector in many rows
    rows += [(2000, None), (2001, [1.0, None]), (2010, [float("nan")] * 8), (2020, [1.0, 2.0]), (2030, []), (None, vectors[0]), (None, vectors[3]), (50, vectors[7]), (-50, vectors[8]), (10, vectors[10])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, vec string, bucket int").repartition(4)
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == top_brute(rows, lambda q: q is not None and q % 10 == 0)


def test_top_k_of_few_rows(spark):
    kind = "vec_id long, embedding array<double>"
    every = F.lit(True)
    assert topk.top_k(spark.createDataFrame([], kind), every).count() == 0
    assert topk.top_k(spark.createDataFrame([(1, [1.0]), (1, None)], kind), every).count() == 0
    rows = [(1, [1.0, -3.0]), (2, [0.5, 2.0]), (3, [0.5, 2.0]), (4, [1e300, 0.0])]  # the last would pass a long
    got = topk.top_k(spark.createDataFrame(rows, kind), every, k=2)
    assert sorted(repr(tuple(r)) for r in got.collect()) == top_brute(rows[:3], lambda q: True, k=2)


def test_bounds_rule_vectors_out():
    """A block of far vectors isn't evaluated, and bounds are never below scores."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(50, 8)) * 5 + 300, rng.normal(size=(500, 8)) * 5 - 300]).astype(np.int64)
    pivots = topk.farthest_first(x.astype(float), 8)
    dist, norm = topk.distances(x, pivots), (x * x).sum(axis=1)
    for j in range(0, 550, 7):
        bound = topk.upper(float(norm[j]), norm.astype(float), np.abs(dist - dist[j]).max(axis=1))
        assert (bound >= x @ x[j]).all()
    fifth = np.sort(x @ x[0])[-5]
    assert (topk.upper(float(norm[0]), norm.astype(float), np.abs(dist - dist[0]).max(axis=1)) >= fifth).sum() <= 50


# ---------------------------------------------------------------- phrases


def phrases_brute(rows, least, top, share=50, words=3):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, words + 1):
                for i in range(len(w) - n + 1):
                    counts[lang, tuple(w[i : i + n])] += 1
    found = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    gone = set()
    for (lang, long), f in found.items():
        for a, b in itertools.combinations(range(len(long) + 1), 2):
            part = (lang, long[a:b])
            if b - a < len(long) and part in found and 100 * f >= share * found[part]:
                gone.add(part)
    out = []
    for lang in {p[0] for p in found}:
        rows_ = []
        for (at, w), a in found.items():
            if at == lang and (at, w) not in gone:
                cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
                score, _, left, right = min(cuts)
                rows_.append((-score, -a, " ".join(w).encode(), " ".join(w), left, right))
        out += [(lang, r + 1, p, -a, left, right, totals[lang], -s) for r, (s, a, _, p, left, right) in enumerate(sorted(rows_)[:top])]
    return sorted(map(repr, out))


@pytest.mark.parametrize("batch", [1 << 23, 500])
def test_collocations(spark, awkward, nothing, batch):
    rng = random.Random(3)
    vocabulary = ["a", "A", "aa", "é", "ß", "x.y", "don't", "\x00", "🙂", " ", "ÀÇ", "the"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ""]) for _ in range(rng.randrange(120)))
        rows.append((rng.choice(["en", "de", None, ""]), text if i % 17 else None))
    rows += [("en", "a a a a a a")] * 3 + [("und", "the the the")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "lang string, text string, phrase string").repartition(3)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    # in the workers batches are of one size; there the second size cuts texts up in this process
    many = list(phrases.batches_by_lang(iter(texts.toArrow().to_batches()), batch))
    assert sum(len(t) for _, t in many) == sum(len(phrases.rewritten((t or "").encode())) for _, t in rows)
    for least, top in ((3, 40), (1, 5)):
        got = phrases.collocations(docs, least=least, top=top)
        assert sorted(repr(tuple(r)) for r in got.collect()) == phrases_brute(rows, least, top)
    got = phrases.collocations(awkward, least=2)
    assert sorted(repr(tuple(r)) for r in got.collect()) == phrases_brute([(r.lang, r.text) for r in awkward.collect()], 2, 2000)
    assert phrases.collocations(nothing).count() == 0


def test_sketch_bounds_frequencies_from_above(spark):
    """Every phrase that reaches the least frequency passes, however small the sketch; a large one passes few others."""
    texts = spark.createDataFrame([("en", prose(i % 9, 400)) for i in range(60)], "lang string, text string").repartition(6)
    whole = b"".join(phrases.rewritten(prose(i % 9, 400).encode()) for i in range(60))
    seen = phrases.Words("en", whole)
    for width in (phrases.SLICE, 1 << 22):
        bits = phrases.sketched(texts, width, 7, 3)
        for n in (1, 2, 3):
            _, hashes = seen.phrases(n)
            values, counts = np.unique(hashes, return_counts=True)
            passed = phrases.reaches(bits, values)
            assert passed[counts >= 7].all()
            if width == 1 << 22:
                assert passed[counts < 7].mean() < 0.01 if (counts < 7).any() else True


def test_exact_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 10**11), ("en", "b", 1, 3 * 10**11), ("en", "a b", 2, 10**11 - 7)], "lang string, phrase string, k int, f long")
    assert [r.score for r in phrases.scored(counts).collect()] == [10**6 * (10**11 - 7) ** 2 // (3 * 10**22)]
