"""Line dedup (operator 1), in DataFrame operations only.

A document is the sequence of its lines; lines of white space alone are left out of it and stay in
the text. A run is repeated when it also occurs earlier (smaller doc_id, or earlier in the same
document), judged on the input. A line goes when a repeated run of `window` lines covers it, or
when it has `long_words` words or more and is repeated by itself. The queries take a window of
WINDOW lines and lines of LONG_WORDS words, so that what stays of repeated lines is shorter than
that and has other neighbours; a window of one removes every line that occurs earlier.

Winnowing: of every `window` lines in a row the one with the smallest hash is the run's fingerprint,
and a long line is its own, so a run and its earlier copy have one fingerprint. Spark sorts the runs
that hold a fingerprint by the run and by place; a run equal to the one before it in that sort is
repeated. Every run is kept, not only those around minima: with windows as short as two lines a match
reaches as far as its overlapping runs are repeated, which is what extending it from a minimum both ways
would find, so there is no step of its own for that. Nothing is paired
with all its copies, so rows grow with the input however often a line occurs. Fingerprints with more
than one in HOT of all rows, fewer than HOT in number, are not sorted together: their runs' first
places are found by an aggregation that starts in each task, and joined with rows dealt over many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import HOT, NULL_ID, cut, id_key, own_columns, salted_join, twin_key

#: Lines of a run that is always found, and words of a line that counts by itself, as the queries and the pipeline have them.
WINDOW, LONG_WORDS = 2, 5


def _hash(*x: Column) -> Column:
    """128 bits: two hashes from different seeds."""
    return F.struct(F.xxhash64(F.lit(11), *x).alias("a"), F.xxhash64(F.lit(22), *x).alias("b"))


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def _blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\f\v", "    ")) == ""


def _key() -> Column:
    return F.struct(id_key().alias("id"), twin_key().alias("twin"))


def runs(docs: DataFrame, window: int, long_words: int) -> DataFrame:
    """id, twin, start, places, fp, a, b: every run of `window` lines, and every long line, with its fingerprint and its hash (a, b).

    start: the place of a run's first line among all lines of the text; places: those of all its lines.
    A text's lines are an array; shifted copies of it side by side are its windows, so no row moves.
    """
    line = lambda x, i: F.struct(i.alias("at"), F.xxhash64(F.lit(11), x).alias("a"), F.xxhash64(F.lit(22), x).alias("b"), (_spaces(x) >= long_words - 1).alias("long"), _blank(x).alias("blank"))
    rows = docs.select("*", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines_"))
    rows = rows.select(id_key().alias("id"), twin_key().alias("twin"), F.filter(F.transform("lines_", line), lambda x: ~x["blank"]).alias("x0"))
    ahead = [F.slice("x0", F.lit(k + 1), F.size("x0")).alias(f"x{k}") for k in range(1, window)]
    rows = rows.select("id", "twin", F.explode(F.arrays_zip("x0", *ahead)).alias("w")).select("id", "twin", "w.*")
    held = [F.col(f"x{k}") for k in range(window)]
    one = F.struct(F.array("x0.at").alias("places"), F.col("x0.a").alias("fp"), F.col("x0.a").alias("a"), F.col("x0.b").alias("b"))
    if window == 1:
        found = F.array(one)
    else:
        whole = _hash(F.lit(window), *(x["a"] for x in held), *(x["b"] for x in held))
        run = F.struct(F.array(*(x["at"] for x in held)).alias("places"), F.least(*(x["a"] for x in held)).alias("fp"), whole["a"].alias("a"), whole["b"].alias("b"))
        full = F.col(f"x{window - 1}").isNotNull()
        found = F.when(full & F.col("x0.long"), F.array(one, run)).when(full, F.array(run)).when(F.col("x0.long"), F.array(one))
    return rows.select("id", "twin", F.col("x0.at").alias("start"), F.explode(found).alias("r")).select("id", "twin", "start", "r.*")


def repeated_lines(docs: DataFrame, window: int = 1, long_words: int = LONG_WORDS) -> DataFrame:
    """key, gone: per document the places of the lines that go. Documents without any are left out."""
    rows = cut(runs(docs, window, long_words))
    most = rows.count() // HOT + 1
    hot = cut(rows.groupBy("fp").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("fp"))
    run, spot = ["fp", "a", "b"], ["id", "twin", "start"]
    order = Window.partitionBy("fp").orderBy("a", "b", *spot)
    cold = rows.join(F.broadcast(hot), "fp", "left_anti")
    before = lambda c: F.lag(c).over(order) == F.col(c)
    later = cold.withColumn("again", before("a") & before("b")).filter("again").select("id", "twin", "places")
    common = rows.join(F.broadcast(hot), "fp")
    firsts = common.groupBy(*run).agg(F.min(F.struct(*spot)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = cut(firsts.select(*run, "first", "n"))
    later = later.unionByName(salted_join(common, firsts, run, spot).filter(F.struct(*spot) > F.col("first")).select("id", "twin", "places"))
    gone = later.select("id", "twin", F.explode("places").alias("i")).groupBy("id", "twin").agg(F.collect_set("i").alias("gone"))
    return gone.select(F.struct("id", "twin").alias("key"), "gone")


def dedup_lines(docs: DataFrame, window: int = 1, long_words: int = LONG_WORDS) -> DataFrame:
    """row (the whole input row), text (what is left), n_lines, n_removed of every row.

    A null text is empty and stays null. A removed line goes with its newline. Texts may become
    empty; their rows stay. Rows with one doc_id, or with none, and unlike texts are documents of
    their own, in the order of the texts' hashes. Rows that repeat both doc_id and text are one
    document, but of those without a doc_id one is the first and the others are its copies.
    """
    rows = own_columns(docs)
    found = repeated_lines(rows, window, long_words)
    rows = rows.withColumn("key", _key()).join(found, "key", "left")
    again = (F.col("key.id") == F.lit(NULL_ID)) & (F.row_number().over(Window.partitionBy("key").orderBy("key")) > 1)
    rows = rows.withColumn("again", again).withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    every = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~_blank(F.get("lines", i)))
    alone = F.filter(every, lambda i: _spaces(F.get("lines", i)) >= long_words - 1)
    rows = rows.withColumn("gone", F.when(F.col("again"), F.when(F.size(every) >= window, every).when(F.size(alone) > 0, alone)).otherwise(F.col("gone")))
    rows = rows.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"))
    kept = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    return rows.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


ORACLE = f"""
with a as (select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
b as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from a),
c as (select *, row_number() over (partition by doc_id order by i) as p, lead(line) over (partition by doc_id order by i) as line2
  from b where trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> ''),
d as (select *, length(line) - length(replace(line, ' ', '')) >= {LONG_WORDS - 1} as is_long,
  row_number() over (partition by line order by doc_id, p) > 1 as again,
  line2 is not null and row_number() over (partition by line, line2 order by doc_id, p) > 1 as again2 from c),
e as (select *, (is_long and again) or again2 or coalesce(lag(again2) over (partition by doc_id order by p), false) as gone from d),
f as (select doc_id, i from e where gone),
g as (select b.doc_id, string_agg(line, chr(10) order by i) as text, count(*) as kept from b anti join f on b.doc_id = f.doc_id and b.i = f.i group by 1)
select a.doc_id, coalesce(g.text, '') as text, cast(len(ls) as bigint) as n_lines, cast(len(ls) - coalesce(kept, 0) as bigint) as n_removed
from a left join g on a.doc_id = g.doc_id
"""
