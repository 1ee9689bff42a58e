"""Labels of components: chains, stars, loops and random graphs; rounds never join edges with labels."""

import random

from ledgerloom.llm import jaccard


def expected(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in up)


def test_labels(spark):
    rng = random.Random(3)
    chain = list(range(200))
    rng.shuffle(chain)
    edges = [*zip(chain, chain[1:]), (500, 500), (-7, 600), (600, 601), *((700, x) for x in range(701, 760)), *((900 + rng.randrange(80), 900 + rng.randrange(80)) for _ in range(60))]
    found = jaccard.min_labels(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == expected(edges)


def test_no_round_joins_edges_with_labels(spark, monkeypatch):
    plans = []
    real = jaccard.cut

    def spy(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)

    monkeypatch.setattr(jaccard, "cut", spy)
    edges = [(i, i + 1) for i in range(30)]
    found = jaccard.min_labels(spark.createDataFrame(edges, "a long, b long"))
    assert {r["label"] for r in found.collect()} == {0}
    assert len(plans) < 12
    assert not any("Join" in p for p in plans)
