"""How well a clustering agrees with the true one, from counts of cluster pairs: no pair of elements is ever listed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(n: Column) -> Column:
    """n * (n - 1) / 2, exact beyond 64 bits."""
    n = n.cast("decimal(19,0)")
    return (n * (n - 1)).cast("decimal(38,0)")


def clustering_quality(rows: DataFrame, predicted: str, actual: str, element: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, elements, pair_precision, pair_recall, false_merge_rate, bcubed_precision, bcubed_recall.

    rows: one per element. An element without a cluster (null) is one by itself, named by the columns of `element`.
    false_merge_rate is the share of merged pairs that aren't together in truth. Without a merged pair, or without a true one,
    the share of them is null. Each element weighs alike in the B-cubed measures: the share of its cluster that
    belongs to it, and the share of what belongs to it that is in its cluster.
    """
    alone = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in element])
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.concat(F.lit("!"), alone))
    cells = rows.select(*by, named(predicted).alias("p_"), named(actual).alias("a_")).groupBy(*by, "p_", "a_").agg(F.count("*").alias("n_"))
    side = lambda c: cells.groupBy(*by, c).agg(F.sum("n_").alias(f"{c}n"))
    merged, true = side("p_"), side("a_")
    both = cells.join(merged, [*by, "p_"]).join(true, [*by, "a_"])
    share = lambda of: F.sum(F.col("n_").cast("double") * F.col("n_") / F.col(of)) / F.sum("n_")
    right = both.groupBy(*by).agg(F.sum("n_").alias("elements"), F.sum(_pairs(F.col("n_"))).alias("right"), share("p_n").alias("bcubed_precision"), share("a_n").alias("bcubed_recall"))
    total = lambda df, c, name: df.groupBy(*by).agg(F.sum(_pairs(F.col(c))).alias(name))
    sides = [total(merged, "p_n", "merged"), total(true, "a_n", "true")]
    for s in sides:
        right = right.join(s, list(by)) if by else right.crossJoin(s)  # a row each
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b).cast("double"))
    return right.select(*by, "elements", ratio("right", "merged").alias("pair_precision"), ratio("right", "true").alias("pair_recall"), (1 - ratio("right", "merged")).alias("false_merge_rate"), "bcubed_precision", "bcubed_recall")
