"""Rows that share a doc_id, or have none, are judged each by itself in operators 3 and 9."""

from __future__ import annotations

import pytest
from ledgerloom.llm import decontam, jaccard
from llm.conftest import prose
from llm.test_dedup import edits, sets_brute

A, B, C, D = (prose(70 + i, 60).replace("\n", " ") for i in range(4))


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("shared", [None, 7])
def test_a_shared_id_links_nothing(spark, shared):
    rows = [(5, A), (9, B), (shared, A), (shared, B), (shared, C), (11, D), (shared, None), (shared, "")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or -1) for r in jaccard.classes(rows_of(spark, rows)).collect())
    n = 56
    own = -1 if shared is None else shared
    twins = [(shared is None, shared or 0, n, 5), (shared is None, shared or 0, n, min(9, shared or 9)), (shared is None, shared or 0, n, own)]
    empty = [(shared is None, shared or 0, 0, own)] * 2
    assert got == sorted([(False, 5, n, 5), (False, 9, n, min(9, shared or 9)), (False, 11, n, 11), *twins, *empty])


def test_every_set_meets_its_near_copies(spark):
    near = A.split(" ")
    near[30] = "other"
    rows = [(None, B), (None, A), (None, " ".join(near)), (20, A.upper()), (21, C)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.classes(rows_of(spark, rows)).collect() if r.doc_id}
    assert got == {(20, 56): 20, (21, 56): 21}
    rows = [(3, A), (3, B), (8, " ".join(near)), (9, B)]
    got = sorted((r.doc_id, r.component_id) for r in jaccard.classes(rows_of(spark, rows)).collect())
    assert got == [(3, 3), (3, 3), (8, 3), (9, 3)]
    near2 = " ".join(["new", *near[1:]])
    rows = [(8, A), (3, C), (3, " ".join(near)), (1, near2)]  # 1 and 8 meet only through the second text of 3
    got = sorted((r.doc_id, r.component_id) for r in jaccard.classes(rows_of(spark, rows)).collect())
    assert got == [(1, 1), (3, 1), (3, 3), (8, 1)]


def test_keep_one_drops_copies_only(spark):
    rows = [(5, A), (7, A), (7, B), (None, C), (None, C), (None, A), (None, D), (9, D), (None, None), (None, "")]
    kept = sorted((r.doc_id or -1, r.text or "") for r in jaccard.keep_one(rows_of(spark, rows)).collect())
    assert kept == sorted([(5, A), (7, B), (-1, C), (9, D), (-1, ""), (-1, "")])


@pytest.mark.parametrize("shared", [None, 4])
def test_only_contaminated_rows_go(spark, shared):
    item = prose(90, 40)
    rows = [(shared, prose(1, 30) + " " + item), (shared, B), (shared, None), (6, C)]
    benchmark = spark.createDataFrame([(1, item), (1, "unrelated words of one item"), (None, D)], "item_id long, text string")
    docs = rows_of(spark, rows)
    assert sorted(r.text or "" for r in decontam.decontaminate(docs, benchmark).collect()) == sorted([B, "", C])
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, benchmark).collect()] == [(shared, 1)]
    docs = rows_of(spark, [*rows, (12, "x " + D)])  # items that share an id, or have none, are all searched for
    assert sorted(r.item_id or 0 for r in decontam.contaminated(docs, benchmark).collect()) == [0, 1]


@pytest.mark.parametrize("cell", [6, 15, 40])
def test_cells_lose_no_link(spark, cell):
    """Groups wider than a pivot's reach, chains, and groups with a passage in common, cut into small cells."""
    import numpy as np

    rng = np.random.default_rng(cell)
    texts = []
    for f in range(3):
        base = prose(f, 120)
        texts += [edits(base, rng, int(rng.integers(0, 7))) for _ in range(35)]
    words = [f"w{i}" for i in range(500)]
    texts += [" ".join(words[i * 9 : i * 9 + 120]) for i in range(40)]
    texts += [prose(300, 70) + " " + prose(301 + i, int(rng.integers(3, 60))) for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(rows_of(spark, list(enumerate(texts))), cell, 10**6).collect()}
    assert got == sets_brute(list(enumerate(texts)))


def test_cells_are_cut_and_smaller(spark):
    """A large group leaves cells of what isn't settled only."""
    import numpy as np

    rng = np.random.default_rng(3)
    base = prose(1, 200)
    texts = [edits(base, rng, 1) for _ in range(60)] + [edits(base, rng, 30) for _ in range(6)]
    sets = [("r", i, [int(x) for x in s.view(np.int64)]) for i, s in enumerate(jaccard.shingle_sets([t.encode() for t in texts]))]
    frame = spark.createDataFrame(sets, "region string, key long, hashes array<long>")
    links, cells = jaccard.voronoi(frame, jaccard.sizes(frame), 20, 10**9, 0)
    linked = {r.a for r in links.collect()} | {r.b for r in links.collect()}
    cores = set(range(66)) - linked
    held = {}
    for r in cells.select("region", "key").collect():
        held.setdefault(r.region, set()).add(r.key)
    assert len(linked) >= 50 and cores
    assert all(any(c in keys for keys in held.values()) for c in cores)
    # what is near a core is in a cell with it, by all pairs
    plain = {i: set(h) for _, i, h in sets}
    for i in cores:
        for j in range(66):
            if i != j and 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j]):
                assert any({i, j} <= keys for keys in held.values())
