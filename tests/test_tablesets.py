"""Sets of tables: all or nothing, and what a broken write leaves."""

from __future__ import annotations

import pytest
from ledgerloom.operators import ledger
from ledgerloom.sources.tablesets import TableSets
from pyspark.sql import functions as F


class Stop(Exception):
    pass


def test_a_write_that_stops_between_tables(spark, tmp_path):
    sets = TableSets(spark, f"file://{tmp_path}/ledger")
    assert sets.newest() is None and sets.tables() == {}
    with pytest.raises(LookupError):
        sets.read("a")
    first = sets.write("run-1", {"a": spark.range(3), "b": spark.range(4)})

    class Broken:
        """A table whose write fails, after those before it were written."""

        @property
        def write(self):
            raise Stop

    with pytest.raises(Stop):
        sets.write("run-2", {"a": spark.range(100), "b": Broken()})
    assert sets.newest() == first and {n: t.count() for n, t in sets.tables().items()} == {"a": 3, "b": 4}
    failing = spark.range(5).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        sets.write("run-2", {"a": spark.range(100), "b": failing})
    assert sets.read("a").count() == 3
    second = sets.write("run-2", {"a": spark.range(100), "b": spark.range(7)})
    assert (second.number, sets.read("a").count(), sets.read("b").count()) == (2, 100, 7)
    assert sets.read("a", first).count() == 3  # who began with a set goes on with it
    assert sets.write("run-1", {"a": spark.range(9)}) == first and sets.newest() == second  # a run is written once
    gone = sets.clean(keep=1)
    assert len(gone) == 3 and first.folder in gone
    assert sets.commits() == [second] and sets.read("b").count() == 7
    with pytest.raises(ValueError, match="run key"):
        sets.write("../x", {})


def test_two_writers_of_one_number(spark, tmp_path):
    """Both sets are whole; every reader takes the same one."""
    one, two = (TableSets(spark, str(tmp_path / "s")) for _ in range(2))
    one.write("r1", {"a": spark.range(1)})
    two.newest = lambda run_key=None: None  # as if it had looked before the first commit
    late = two.write("r2", {"a": spark.range(2)})
    assert late.number == 1 and [c.run_key for c in one.commits()] == ["r1", "r2"] and one.read("a").count() == 2


def test_ancestry_of_a_chain_in_logarithmic_rounds(spark, monkeypatch):
    written = []
    plain = ledger.checkpointed
    monkeypatch.setattr(ledger, "checkpointed", lambda df: written.append(1) or plain(df))
    n = 600
    runs = spark.range(n).select(F.concat(F.lit("r"), "id").alias("run_key"), F.array(F.col("id").cast("string")).alias("inputs"), F.array((F.col("id") + 1).cast("string")).alias("outputs"))
    found = ledger.ancestry(ledger.lineage_edges(runs))
    assert found.count() == n * (n + 1) // 2
    assert found.filter(F.col("artifact").cast("int") - F.col("ancestor").cast("int") != F.col("depth")).count() == 0
    assert len(written) <= 2 * 11 + 1  # 2 ** 10 > 600


def test_ancestry_takes_the_shortest_way(spark):
    """Several ways, and a cycle with a tail."""
    pairs = [("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("x", "d")]
    runs = spark.createDataFrame([(f"r{i}", [a], [b]) for i, (b, a) in enumerate(pairs)], "run_key string, inputs array<string>, outputs array<string>")
    want: dict = {}
    for start in {b for b, _ in pairs}:
        edge, depth = {a for b, a in pairs if b == start}, 1
        while edge:
            for a in edge:
                want[start, a] = depth
            edge, depth = {a for b, a in pairs if b in edge} - {a for s, a in want if s == start}, depth + 1
    assert {(r.artifact, r.ancestor): r.depth for r in ledger.ancestry(ledger.lineage_edges(runs)).collect()} == want
