r"""Document fingerprints (operator 10), in DataFrame operations only.

A text is a tree: sections are parted by an empty line, paragraphs by a newline, and a paragraph's
leaves are pieces of some words with the spaces behind them, so that the leaves behind one
another are the paragraph again. A piece ends where its content says so, behind a word that ends in one of a
few characters (about every third word) or after LONGEST words, so a word put in or taken out
changes the pieces around it and no others. A leaf's node is the SHA-256 of its piece, a paragraph's that of
its leaves' nodes, a section's that of its paragraphs' nodes, and the root, the fingerprint, that of
its sections' nodes. Roots are equal exactly when texts are; `differing` follows unequal branches
down to the paragraphs that were edited. The likeness of two trees is the share of leaf nodes that
they have in common, read from the trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_key, parts, text_or_empty, twin_key

#: Last characters of a word that end a piece, and the most words of one.
ENDS, LONGEST = "es.", 8
LEAF = rf"(?:[^ ]*[^ {ENDS}] +){{0,{LONGEST - 1}}}[^ ]+ *| +"


def tree(text: Column) -> Column:
    """array of (node, paragraphs: array of (node, leaves: array of nodes)), one per section."""
    return F.transform(F.split(text, "\n\n", -1), lambda s: _section(F.transform(F.split(s, "\n", -1), _paragraph)))


def _joined(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _paragraph(text: Column) -> Column:
    leaves = F.transform(F.regexp_extract_all(text, F.lit(LEAF), F.lit(0)), lambda x: F.sha2(x, 256))
    return F.transform(F.array(leaves), lambda x: F.struct(_joined(x).alias("node"), x.alias("leaves")))[0]


def _section(paragraphs: Column) -> Column:
    return F.transform(F.array(paragraphs), lambda x: F.struct(_joined(x["node"]).alias("node"), x.alias("paragraphs")))[0]


def root(sections: Column) -> Column:
    return _joined(sections["node"])


def fingerprint(text: Column) -> Column:
    return root(tree(text))


def leaves(sections: Column) -> Column:
    """The distinct leaf nodes of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(sections, lambda s: s["paragraphs"]["leaves"]))))


def likeness(a: Column, b: Column) -> Column:
    """Of two trees' leaf nodes: common ones over those of the larger; two empty texts are alike."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / most)


def differing(a: Column, b: Column) -> Column:
    """Where two trees differ: array of (section, paragraph), counted from 0; branches with equal nodes are not entered."""
    sections = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)

    def inside(i: Column) -> Column:
        x, y = F.get(a, i)["paragraphs"]["node"], F.get(b, i)["paragraphs"]["node"]
        both = F.sequence(F.lit(0), F.greatest(F.coalesce(F.size(x), F.lit(0)), F.coalesce(F.size(y), F.lit(0))) - 1)
        unequal = F.filter(both, lambda j: ~F.get(x, j).eqNullSafe(F.get(y, j)))
        return F.transform(unequal, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    changed = F.filter(sections, lambda i: ~F.get(a, i)["node"].eqNullSafe(F.get(b, i)["node"]))
    return F.flatten(F.transform(changed, inside))


#: Cuts of the first and of the second level, so that a row is compared with two short lists however many ranges there are.
FANOUT = 150


def _ranges(rows: DataFrame, n: int) -> Column:
    """Number of the range of about 1 / n of the rows that a key lies in; a key with many rows is cut by twin."""
    cuts = sorted(rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n)).first()[0] or [])
    times = {c: cuts.count(c) for c in set(cuts)}
    known = sorted(times)
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<long>")
    groups = [known[i : i + FANOUT] for i in range(0, len(known), FANOUT)]
    below = lambda xs: F.size(F.filter(xs, lambda c: c < F.col("key")))
    upper = below(longs([g[-1] for g in groups[:-1]]))
    inner = below(F.get(F.array(*map(longs, groups)), upper)) if groups else F.lit(0)
    hot = [k for k, m in times.items() if m > 1]
    part = F.lit(0)
    if hot:  # fewer than n keys; twin is a hash, so equal shares of its span hold about as many rows
        share = F.element_at(F.create_map(*[F.lit(x) for k in hot for x in (k, times[k])]), F.when(F.col("key").isin(hot), F.col("key")))
        part = F.coalesce(F.floor((F.col("twin") / F.lit(2.0**64) + 0.5) * share), F.lit(0))
    return (upper * FANOUT + inner).cast("long") * F.lit(10 * n) + (F.lit(10 * n - 1) - part).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next row by descending doc_id; the first row's after the last.

    Ties are ordered by the hash of their text, then by text; null ids come last and null texts are
    empty. Rows are cut into ranges of about equal counts, each range is a window of its own, and
    each also gets the first row of the range below it, so no window holds all rows.
    """
    rows = docs.select("doc_id", id_key().alias("key"), twin_key().alias("twin"), text_or_empty().alias("text"))
    rows = rows.withColumn("bucket", _ranges(rows, 4 * parts(docs.sparkSession))).withColumn("guest", F.lit(False))
    top = F.min(F.struct(F.bitwise_not("key").alias("down"), F.col("twin").alias("twin")))
    firsts = sorted((b, ~x.down, x.twin) for b, x in rows.groupBy("bucket").agg(top).collect())  # a row per range
    if not firsts:
        return rows.select("doc_id", "text", F.lit("").alias("next_text"))
    below = [(key, twin, b) for (b, _, _), (_, key, twin) in zip(firsts, [firsts[-1], *firsts[:-1]], strict=True)]
    host = docs.sparkSession.createDataFrame(below, "key long, twin long, bucket long")
    # a row per range, 4 times the shuffle partitions
    guests = rows.drop("bucket", "guest", "doc_id").join(F.broadcast(host), ["key", "twin"]).groupBy("key", "twin", "bucket").agg(F.min("text").alias("text"))
    guests = guests.select(F.lit(None).cast("long").alias("doc_id"), "key", "twin", "text", "bucket", F.lit(True).alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("key"), "twin", "text")
    found = rows.unionByName(guests).withColumn("next_text", F.lead("text").over(order))
    return found.filter(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """The last third (rounded down) of the code points replaced by as many first ones of the other text, or all."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def compare_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_differing of every row.

    Repeated rows each have a result; the only row of a table is its own next. n_differing counts
    the paragraphs that `differing` finds between the text and the edited text.
    """
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("tree"),
        tree(F.col("edited")).alias("edited_tree"),
        tree(F.col("next_text")).alias("next_tree"),
    )
    rows = rows.select("*", leaves(F.col("tree")).alias("own"), leaves(F.col("edited_tree")).alias("changed"), leaves(F.col("next_tree")).alias("other"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        root(F.col("tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
        F.size(differing(F.col("tree"), F.col("edited_tree"))).cast("long").alias("n_differing"),
    )


def _sql_leaves_of(p: str) -> str:
    return f"list_transform(regexp_extract_all({p}, '{LEAF}'), lambda x: sha256(x))"


def _sql_tree(text: str) -> str:
    """list per section of lists per paragraph of (p: node, l: leaf nodes)."""
    leaf = _sql_leaves_of("p")
    return (
        f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: "
        f"list_transform(string_split(s, chr(10)), lambda p: struct_pack(p := sha256(array_to_string({leaf}, '')), l := {leaf})))"
    )


def _sql_root(tree_: str) -> str:
    return f"sha256(array_to_string(list_transform({tree_}, lambda s: sha256(array_to_string(list_transform(s, lambda x: x.p), ''))), ''))"


def _sql_flat(tree_: str) -> str:
    """(section, paragraph, node) of every paragraph."""
    return f"flatten(list_transform({tree_}, lambda s, i: list_transform(s, lambda x, j: struct_pack(i := i, j := j, p := x.p))))"


def _sql_leaves(tree_: str) -> str:
    return f"list_distinct(flatten(flatten(list_transform({tree_}, lambda s: list_transform(s, lambda x: x.l)))))"


def _sql_like(a: str, b: str) -> str:
    return f"case when greatest(len({a}), len({b})) = 0 then 1.0 else len(list_intersect({a}, {b})) / greatest(len({a}), len({b})) end"


ORACLE = f"""
with a as (select doc_id, coalesce(text, '') as text from documents),
b as (select *, coalesce(lead(text) over w, first_value(text) over w) as nxt from a window w as (order by doc_id desc, text)),
c as (select *, text[1:length(text) - length(text) // 3] || nxt[1:length(text) // 3] as edited from b),
d as (select doc_id, text, edited, {_sql_tree('text')} as t, {_sql_tree('edited')} as e, {_sql_tree('nxt')} as nt from c),
f as (select *, {_sql_leaves('t')} as own, {_sql_leaves('e')} as changed, {_sql_leaves('nt')} as other, {_sql_flat('t')} as ta, {_sql_flat('e')} as tb from d)
select doc_id, cast(length(text) as bigint) as n_chars, sha256(edited) as edited_sha256,
  {_sql_root('t')} as fingerprint, {_sql_root('e')} as edited_fingerprint,
  {_sql_like('own', 'changed')} as near_edited, {_sql_like('own', 'other')} as near_next,
  cast(len(ta) + len(tb) - len(list_intersect(list_transform(ta, lambda x: struct_pack(i := x.i, j := x.j)), list_transform(tb, lambda x: struct_pack(i := x.i, j := x.j))))
    - len(list_intersect(ta, tb)) as bigint) as n_differing
from f
"""
