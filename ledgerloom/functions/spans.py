"""Matches of a pattern with their places: Spark has no built-in that returns offsets.

The matches, and the matches with what lies before each, are two arrays; the lengths of the second add up to the
ends: sums of pieces of CHUNK first, then inside each piece, so the time follows the number of matches.
Offsets are code points, so substring(text, start + 1, end - start) is the match again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "cast(array() as array<struct<start:int,end:int,value:string>>)"
NOTHING = "cast(array() as array<struct<rule:string,rule_version:string,start:int,end:int,value:string>>)"


#: A fold that adds to an array copies it at each step, so arrays stay this short.
CHUNK = 256

#: Up to so many matches of a text are looked for one by one.
FEW = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once.

    Spark runs a lambda's body as a tree of expressions, each in code that the JVM compiles. The same steps as plain
    columns become one generated method, which the JVM interprets where it is too long.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _locate(part: Column, text: Column, first: Column) -> Column:
    """The place of part in text, from 1, at first or behind; 0 if there is none."""
    return F.call_function("locate", part, text, first)


def _sums(steps: Column, first: Column) -> Column:
    """first, and first plus each prefix of a short array but the whole."""
    zero = F.struct(first.alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    return F.aggregate(steps, zero, lambda done, x: F.struct((done["at"] + x).alias("at"), F.array_append(done["out"], done["at"]).alias("out")))["out"]


def running(steps: Column) -> Column:
    """The sum of the steps before each step of an array of int."""

    def joined(pieces: Column) -> Column:
        firsts = _sums(F.transform(pieces, lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b)), F.lit(0))
        return F.flatten(F.zip_with(pieces, firsts, _sums))

    def summed(all_: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.size(all_) - 1, F.lit(CHUNK)), lambda i: F.slice(all_, i + 1, F.lit(CHUNK)))
        return F.when(F.size(all_) <= CHUNK, _sums(all_, F.lit(0))).otherwise(let(pieces, joined))

    return let(steps, summed)


def spans(text: Column, pattern: str) -> Column:
    """array of (start, end, value) of the matches, left to right; the pattern never matches nothing."""

    # from the end of the match before up to the end of the next one; split would compile the pattern for every row
    upto = F.lit(rf"\G(?s:.*?)(?:{pattern})")
    made = lambda end, v: F.struct((end - F.length(v)).alias("start"), end.alias("end"), v.alias("value"))

    def placed(found: Column) -> Column:
        ends = lambda steps: F.zip_with(running(steps), steps, lambda at, x: at + x)
        steps = F.transform(F.regexp_extract_all(text, upto, F.lit(0)), lambda x: F.length(x))
        many = let(steps, lambda x: F.zip_with(ends(x), found, made))
        # a few matches whose texts stand nowhere else are found by those, without a second look for the pattern
        at = lambda v: _locate(v, text, F.lit(1))
        once = F.forall(found, lambda v: _locate(v, text, at(v) + 1) == 0)
        few = F.transform(found, lambda v: let(at(v) - 1 + F.length(v), lambda end: made(end, v)))
        return F.when(F.size(found) == 0, F.expr(EMPTY)).when((F.size(found) <= FEW) & once, few).otherwise(many)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


@dataclass(frozen=True)
class Rule:
    """A named, versioned pattern; extraction makes one array per rule and explodes them together."""

    name: str
    pattern: str
    version: str = "1.0.0"


def extract(rows: DataFrame, text: str, rules: list[Rule], where: dict[str, Column] | None = None, more: tuple[Column, ...] = ()) -> DataFrame:
    """Every column of rows, and rule, rule_version, start, end, value: one row per match.

    where: the rows that a rule is looked for in, by its name. more: arrays (not null) of further such rows.
    """
    def made(r: Rule) -> Column:
        own = lambda x: F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))
        found = F.transform(spans(F.col(text), r.pattern), own)
        return F.when(where[r.name], found).otherwise(F.expr(NOTHING)) if where and r.name in where else found

    return rows.select("*", F.explode(F.concat(*more, *map(made, rules))).alias("match_")).select(*rows.columns, "match_.*")
