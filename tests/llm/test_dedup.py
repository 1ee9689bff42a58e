"""Operators 1, 2 and 9 against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
from ledgerloom.llm import jaccard, lines, suffix
from llm.conftest import prose


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


# ---------------------------------------------------------------- lines


def lines_brute(rows, window, long_words):
    """Per doc_id what is left, judged run by run on the input."""
    seqs = {k: [(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\v")] for k, t in rows}
    first: dict = {}
    for k in sorted(seqs):
        for s in range(len(seqs[k])):
            for n in {window, 1}:
                run = tuple(x for _, x in seqs[k][s : s + n])
                if len(run) == n:
                    first.setdefault(run, (k, s))
    out = {}
    for k, t in rows:
        gone = set()
        for s in range(len(seqs[k])):
            for n in {window, 1}:
                run = tuple(x for _, x in seqs[k][s : s + n])
                if len(run) == n and first[run] < (k, s) and (n == window or run[0].count(" ") >= long_words - 1):
                    gone |= {i for i, _ in seqs[k][s : s + n]}
        out[k] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


@pytest.mark.parametrize("window", [1, 2, 3])
def test_repeated_runs_go(spark, window):
    block = [prose(i, 6) for i in range(12)]
    texts = ["\n".join(block[a:b]) for a, b in [(0, 6), (2, 8), (5, 6), (4, 7), (0, 12)]]
    texts += ["\n".join([block[1], "", block[2], "  ", block[3]]), "\n".join([block[9]] * 6), prose(50, 70).replace("\n", " "), "\n".join([block[0], prose(50, 70).replace("\n", " "), block[8]]), ""]
    got = {r.row.doc_id: r.text for r in lines.dedup_lines(documents(spark, texts), window, 50).collect()}
    assert got == lines_brute(list(enumerate(texts)), window, 50)


def test_lines_of_awkward_rows(awkward, nothing):
    rows = lines.dedup_lines(awkward).collect()
    assert len(rows) == awkward.count()
    by = {(r.row.doc_id, r.row.text): r for r in rows}
    assert by[(1, None)].text is None and by[(1, None)].n_removed == 0
    assert by[(7, by_text(awkward, 7))].text == by_text(awkward, 7)  # repeated rows are one document
    assert by[(8, by_text(awkward, 8))].text.strip() == ""  # an exact copy
    assert lines.dedup_lines(nothing).count() == 0


def by_text(df, doc_id):
    return df.filter(f"doc_id = {doc_id}").first().text


# ---------------------------------------------------------------- bytes


def test_repeated_bytes_go(spark):
    a, b = prose(1, 60), prose(2, 60)
    texts = [a, b, a, "x" + a[10:] + b, a[:99], a[:100], "z" * 300, "ab" * 200, a[:150] + b[:150] + a[:150], "é🙂" * 60, "é🙂" * 60 + a[50:220], "", "q" * 99 + a[3:140]]
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(suffix.dedup_bytes(documents(spark, texts))).collect()}
    assert got == suffix.brute_force([(i, t.encode()) for i, t in enumerate(texts)])


@pytest.mark.parametrize("size,gram", [(20, 8), (64, 16), (100, 32)])
def test_random_copies_of_few_letters(spark, size, gram):
    rng = np.random.default_rng(size)
    base = "".join(rng.choice(list("ab"), 600))
    texts = []
    for _ in range(30):
        i, j = sorted(rng.integers(0, 600, 2))
        piece = list(base[i:j])
        if piece and rng.random() < 0.5:
            piece[rng.integers(len(piece))] = "c"
        texts.append("".join(piece) * int(rng.integers(1, 3)))
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(suffix.dedup_bytes(documents(spark, texts), size, gram)).collect()}
    assert got == suffix.brute_force([(i, t.encode()) for i, t in enumerate(texts)], size)


def test_bytes_of_awkward_rows(awkward, nothing):
    rows = suffix.dedup_bytes(awkward).collect()
    assert len(rows) == awkward.count()
    kept = {r.doc_id: bytes(r.kept) for r in rows if r.doc_id is not None}
    assert kept[7] == by_text(awkward, 7).encode() and kept[8] == b"" and kept[1] == b""
    assert suffix.dedup_bytes(nothing).count() == 0


# ---------------------------------------------------------------- sets


def sets_brute(rows):
    sets = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {k: k for k in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {k: (len(sets[k]), label[k]) for k in sets}


def edits(text, rng, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.integers(len(words))] = f"edit{rng.integers(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("cell,refine", [(20_000, 500), (12, 500), (20_000, 3)])
def test_components_are_exact(spark, cell, refine):
    rng = np.random.default_rng(5)
    texts = []
    for f in range(6):
        base = prose(f, int(rng.integers(30, 160)))
        texts += [edits(base, rng, int(rng.integers(0, 9))) for _ in range(12)] + [base, base.upper()]
    passage = prose(99, 60)
    texts += [passage + " " + prose(200 + i, int(rng.integers(3, 40))) for i in range(25)]
    texts += ["one", "One", "one two", "", "  ", None, "one two three four five", "one two three four five one two three four five"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(documents(spark, texts), cell, refine).collect()}
    assert got == sets_brute(list(enumerate(texts)))


def test_chain_of_links(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 8 : i * 8 + 120]) for i in range(30)]  # each like the next, far ones unlike
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(documents(spark, texts)).collect()}
    assert got == sets_brute(list(enumerate(texts)))
    assert {c for _, c in got.values()} == {0}


def test_sets_of_awkward_rows(awkward, nothing):
    rows = jaccard.classes(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert by[7][1] == by[8][1] == by[9][1] == 7 and by[1] == (0, 1) and by[3] == (0, 3) and by[4] == (1, 4)
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    assert jaccard.classes(nothing).count() == 0
    kept = jaccard.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 7, 10, 11, 12, 13, 14]
