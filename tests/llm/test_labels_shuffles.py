"""A round of op9's labels is three shuffles, with equal edges, loops and no edges at all."""

from __future__ import annotations

import random

from ledgerloom.llm import jaccard

from .test_labels_of_stars import expected


def test_a_round_is_three_shuffles(spark, monkeypatch):
    plans, real = [], jaccard.cut

    def spy(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans.append(plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan)
        return real(df)

    monkeypatch.setattr(jaccard, "cut", spy)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(20)] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(60)]
    edges = edges * 2 + [(b, a) for a, b in edges] + [(300, 300)]
    found = jaccard.min_labels(spark.createDataFrame(edges, "a long, b long").repartition(3))
    assert sorted(map(tuple, found.collect())) == expected(edges)
    rounds = plans[1:-1]
    assert rounds and max(p.count("Exchange hashpartitioning") for p in rounds) <= 3


def test_no_edges_give_no_labels(spark):
    assert jaccard.min_labels(spark.createDataFrame([], "a long, b long")).isEmpty()
