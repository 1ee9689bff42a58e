"""Registries with two times: when a value holds (valid time) and when it became known (system time).

A registry is a log of assertions: key, value, valid_from, valid_to (exclusive; null: open), known_at. A later assertion takes
the place of earlier ones for the time it covers; one with a null value takes the value back. Rows are never changed, so what was
known at any time can be asked again. Assertions that cover no time are ignored. Keys are worked on apart, and inside a key every
assertion meets the interval bounds that it covers, so the work is the number of overlaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sound(log: DataFrame) -> DataFrame:
    return log.filter(F.col("valid_from").isNotNull() & F.col("known_at").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))


def timeline(log: DataFrame, key: str, value: str, known_at: Column | None = None) -> DataFrame:
    """key, value, valid_from, valid_to: what holds when, as known at a time (by default: all that is known).

    Valid time is split at every bound of the key's assertions, each piece gets the value known last (of equal times the
    greatest value, null least), and neighbours with one value are one again. Times without a value have no row.
    """
    rows = _sound(log).select(F.col(key).alias("k_"), F.col(value).alias("v_"), "valid_from", "valid_to", "known_at")
    rows = rows.filter(F.col("known_at") <= known_at) if known_at is not None else rows
    order = Window.partitionBy("k_").orderBy("at")
    bounds = rows.select("k_", F.explode(F.array("valid_from", "valid_to")).alias("at")).filter("at is not null").distinct()
    pieces = bounds.select("k_", F.col("at").alias("from_"), F.lead("at").over(order).alias("to_"))
    covers = (F.col("valid_from") <= F.col("from_")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("from_")))
    last = F.max(F.struct("known_at", "v_"))["v_"].alias("v_")
    held = pieces.join(rows, "k_").filter(covers).groupBy("k_", "from_", "to_").agg(last).filter("v_ is not null")
    by = Window.partitionBy("k_").orderBy("from_")
    new = ~(F.lag("to_").over(by).eqNullSafe(F.col("from_")) & F.lag("v_").over(by).eqNullSafe(F.col("v_")))
    runs = held.withColumn("run_", F.sum(new.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("k_", "run_").agg(F.first("v_").alias("v_"), F.min("from_").alias("valid_from"), F.max(F.struct(F.col("to_").isNull(), "to_"))["to_"].alias("valid_to"))
    return found.select(F.col("k_").alias(key), F.col("v_").alias(value), "valid_from", "valid_to")


def as_of(lookups: DataFrame, log: DataFrame, key: str, value: str) -> DataFrame:
    """lookups (key, valid_at, known_at and others) with value: what held at valid_at, as it was known at known_at; null if nothing.

    Every lookup stays, a repeated one too: equal ones are looked up once.
    """
    asked = lookups.select(key, "valid_at", "known_at").distinct()
    rows = _sound(log).select(key, value, "valid_from", "valid_to", F.col("known_at").alias("told_"))
    covers = (F.col("valid_from") <= F.col("valid_at")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_at"))) & (F.col("told_") <= F.col("known_at"))
    found = asked.join(rows, key).filter(covers).groupBy(key, "valid_at", "known_at").agg(F.max(F.struct("told_", value))[value].alias("v_"))
    return lookups.join(found, [key, "valid_at", "known_at"], "left").select(*lookups.columns, F.col("v_").alias(value))
