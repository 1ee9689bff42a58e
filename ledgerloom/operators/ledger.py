"""The evidence ledger: upserts, replacement by run, lineage and constraints, on DataFrames.

Plain tables have no MERGE; an upsert builds the new snapshot, which the caller writes beside the
old one before readers move to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.storage import checkpointed


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[Column | str]) -> DataFrame:
    """One row per key: of both tables' rows the latest by version; new beats old at equal versions."""
    rows = old.withColumn("new_", F.lit(0)).unionByName(new.withColumn("new_", F.lit(1)))
    values = [c for c in rows.columns if c not in keys]
    latest = F.max_by(F.struct(*values), F.struct(*version, "new_"))
    return rows.groupBy(*keys).agg(latest.alias("v_")).select(*keys, *[f"v_.{c}" for c in values if c != "new_"])


def replace_by_run(base: DataFrame, new: DataFrame, run: str) -> DataFrame:
    """base without the runs that new has, and new."""
    return base.join(new.select(run).distinct(), run, "left_anti").unionByName(new)


def insert_missing(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """base and those rows whose key it hasn't: insert, do nothing on conflict. Of rows with one key the first in order stays."""
    order = Window.partitionBy(*keys).orderBy(*[c for c in rows.columns])
    one = rows.withColumn("r_", F.row_number().over(order)).filter("r_ = 1").drop("r_")
    return base.unionByName(one.join(base.select(*keys), list(keys), "left_anti"))


def latest_run(runs: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    values = [c for c in runs.columns if c not in by]
    return runs.groupBy(*by).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("v_")).select(*by, "v_.*")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows: one row per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def lineage_edges(runs: DataFrame) -> DataFrame:
    """run_key, artifact, direction of runs (run_key, inputs, outputs: arrays of artifact hashes)."""
    way = lambda c, d: runs.select("run_key", F.explode(c).alias("artifact"), F.lit(d).alias("direction"))
    return way("inputs", "input").unionByName(way("outputs", "output"))


def ancestry(edges: DataFrame) -> DataFrame:
    """artifact, ancestor, depth (the least): what every artifact was made from, over any number of runs.

    Paths are doubled: with all pairs up to 2^k runs apart and the pairs that a path of just 2^k runs joins, one
    join gives the pairs up to 2^(k+1) apart, and another the paths of twice the length. So a chain of n runs takes
    log2(n) rounds, and each finds its pairs once. A round without a new pair is the last, in a cycle as well.
    """
    made = edges.filter("direction = 'output'").select("run_key", "artifact")
    used = edges.filter("direction = 'input'").select("run_key", F.col("artifact").alias("ancestor"))
    paths = checkpointed(made.join(used, "run_key").select("artifact", "ancestor").distinct())
    found, length = paths.withColumn("depth", F.lit(1)), 1
    while True:
        onward = paths.select(F.col("artifact").alias("ancestor"), F.col("ancestor").alias("next"))
        new = found.join(onward, "ancestor").groupBy("artifact", F.col("next").alias("ancestor")).agg((F.min("depth") + length).alias("depth"))
        new = checkpointed(new.join(found, ["artifact", "ancestor"], "left_anti"))
        if new.isEmpty():
            return found
        found = found.unionByName(new)
        paths = checkpointed(paths.join(onward, "ancestor").select("artifact", F.col("next").alias("ancestor")).distinct())
        length *= 2


def lineage_violations(mentions: DataFrame, blocks: DataFrame, runs: DataFrame) -> DataFrame:
    """Mentions whose block and run are of different captures; nulls are equal to each other only."""
    rows = mentions.join(blocks.select("block_id", F.col("capture").alias("block_capture")), "block_id").join(runs.select("run_key", F.col("capture").alias("run_capture")), "run_key")
    return rows.filter(~F.col("block_capture").eqNullSafe(F.col("run_capture")))


# ---------------------------------------------------------------- constraints


def violations(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """constraint_name, violations: rows for which a check isn't true; one pass, a null check counts as broken."""
    counts = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks.values())]
    pairs = F.array(*[F.struct(F.lit(n).alias("constraint_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(checks)])
    return rows.agg(*counts).select(F.explode(pairs).alias("x")).select("x.*")


def is_sha256(c: str) -> Column:
    return F.col(c).rlike("^[0-9a-f]{64}$")


def is_span(start: str = "start", end: str = "end") -> Column:
    return (F.col(start) >= 0) & (F.col(start) < F.col(end))


def is_box(c: str) -> Column:
    return F.size(c) == 4


def is_page_range(start: str = "start_page", end: str = "end_page") -> Column:
    return (F.col(start) > 0) & (F.col(end) >= F.col(start))


def is_interval(start: str, end: str) -> Column:
    return F.col(end).isNull() | (F.col(end) > F.col(start))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def dangling(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    return child.join(parent.select(*keys), list(keys), "left_anti")


def unlike(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, repeated rows counted."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
