"""Clustering quality against lists of pairs; registries with two times day by day."""

from __future__ import annotations

import itertools
import random

import pytest
from ledgerloom.operators import agreement, bitemporal
from pyspark.sql import functions as F


def test_quality_against_pairs(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None])) for g in "xy" for i in range(40)] + [("z", 1, "a", 1), ("z", 2, None, 1)]
    frame = spark.createDataFrame(rows, "g string, i int, p string, a int").repartition(3)
    got = {r.g: r for r in agreement.clustering_quality(frame, "p", "a", ["i"], ["g"]).collect()}
    for g in "xyz":
        mine = [(i, ("p", p) if p else ("i", i), ("a", a) if a else ("i", i)) for g_, i, p, a in rows if g_ == g]
        pairs = list(itertools.combinations(mine, 2))
        merged, true = [q for q in pairs if q[0][1] == q[1][1]], [q for q in pairs if q[0][2] == q[1][2]]
        right = [q for q in merged if q[0][2] == q[1][2]]
        want = len(right) / len(merged) if merged else None
        assert got[g].elements == len(mine) and got[g].pair_precision == (pytest.approx(want) if merged else None)
        assert got[g].pair_recall == pytest.approx(len(right) / len(true)) and got[g].false_merge_rate == (pytest.approx(1 - want) if merged else None)
        both = lambda k: sum(sum(f[1] == e[1] and f[2] == e[2] for f in mine) / sum(f[k] == e[k] for f in mine) for e in mine) / len(mine)  # noqa: B023, E731
        assert (got[g].bcubed_precision, got[g].bcubed_recall) == (pytest.approx(both(1)), pytest.approx(both(2)))
    whole = agreement.clustering_quality(frame, "p", "a", ["g", "i"]).first()
    assert whole.elements == 82
    assert agreement.clustering_quality(frame.filter("false"), "p", "a", ["i"], ["g"]).count() == 0


def test_two_times_day_by_day(spark):
    rng = random.Random(6)
    log = []
    for k in range(30):
        for t in range(rng.randrange(0, 9)):
            a = rng.randrange(0, 30)
            log.append((k, rng.choice(["u", "v", "w", None]), a, rng.choice([None, a + rng.randrange(-2, 15)]), t))
    frame = spark.createDataFrame(log, "k int, v string, valid_from int, valid_to int, known_at int").repartition(3)

    def holds(k, day, known):
        rows = [(t, v or "", v) for k_, v, a, b, t in log if k_ == k and a <= day and (b is None or day < b) and t <= known]
        return max(rows)[2] if rows else None

    for known in (None, 4):
        found = bitemporal.timeline(frame, "k", "v", None if known is None else F.lit(known)).collect()
        days = {}
        for r in found:
            for day in range(r.valid_from, 60 if r.valid_to is None else r.valid_to):
                assert (r.k, day) not in days
                days[r.k, day] = r.v
        assert {(k, d): days.get((k, d)) for k in range(30) for d in range(60)} == {(k, d): holds(k, d, 99 if known is None else known) for k in range(30) for d in range(60)}
        by_key = {}
        for r in sorted(found, key=lambda r: (r.k, r.valid_from)):
            last = by_key.get(r.k)
            assert not (last and last.valid_to == r.valid_from and last.v == r.v)
            by_key[r.k] = r
    asked = [(k, d, t) for k in range(0, 33, 4) for d in range(0, 40, 3) for t in (0, 3, 8)] + [(0, 0, 0)] * 2
    got = bitemporal.as_of(spark.createDataFrame(asked, "k int, valid_at int, known_at int"), frame, "k", "v").collect()
    assert sorted((r.k, r.valid_at, r.known_at, r.v or "") for r in got) == sorted((k, d, t, holds(k, d, t) or "") for k, d, t in asked)
