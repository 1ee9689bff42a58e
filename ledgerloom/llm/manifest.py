r"""Merkle manifest of a dataset (operator 13), in DataFrame operations only.

A row's leaf is the SHA-256 of its fields, a null one written `-`, another `bytes:value`. The leaves
of one source, by doc_id, are one tree: every 16 neighbours become the SHA-256 of their digests, level
by level, until one is left. The sources' roots, in their order, are the leaves of the tree above them.

Leaves get their place by one range partitioning, then stand in blocks of 256, two levels each: arrays
that `sequence`, `slice`, `transform` and `aggregate` collapse to one node; the blocks' nodes are the next round's
rows. Nothing holds a source whole: a block does, and a source of n rows takes log256(n) rounds.
A proof is a path: what stands left and right of a node in its run, from the leaf's run to the root's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: Nodes of a run, and of a block, which is two levels of runs.
FANOUT = 16
BLOCK = FANOUT * FANOUT

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields behind one another, each `-` if null, else its UTF-8 length, `:` and itself."""
    written = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*written), 256)


def source_key(source: Column) -> Column:
    """A string that is never null and sorts as sources do: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows (key and others) with place, from 0, in the order of their key, and n, the key's rows.

    rows should be a table, as the range partitioning reads it twice. A key's rows may lie in many
    partitions: each has a piece of it, and pieces are counted, not rows, to find where one begins.
    """
    by = [F.col("key").asc(), *(F.col(c).asc_nulls_first() for c in order)]
    # the position behind the shift is the row's in its partition, in sorted order
    ordered = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.select("*", F.shiftright("at", 33).alias("part"), (F.col("at").bitwiseAND(2**33 - 1)).alias("spot")).drop("at")
    pieces = ordered.groupBy("part", "key").agg(F.min("spot").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("key")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("part", "key", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return ordered.join(pieces, ["part", "key"]).withColumn("place", F.col("spot") + F.col("shift")).drop("part", "spot", "shift")


def _join(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _runs(items: Column) -> Column:
    """The items in runs of FANOUT."""
    return F.transform(F.sequence(F.lit(0), F.size(items) - 1, F.lit(FANOUT)), lambda s: F.slice(items, s + 1, F.lit(FANOUT)))


def _levels() -> Column:
    """How many levels a block of a key with n nodes has: none for a lone node."""
    return F.when(F.col("n") <= 1, 0).when(F.col("n") <= FANOUT, 1).otherwise(2)


def blocks(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """key, n, block, items: the key's nodes (key, n, place, node) in arrays of up to BLOCK, in order."""
    item = F.struct("place", "node", *payload)
    return nodes.groupBy("key", "n", F.floor(F.col("place") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items"))


def collapsed(found: DataFrame) -> DataFrame:
    """key, n, place, node: one node of every block, two levels up or where its key's nodes come to an end."""
    up = lambda nodes, _: F.transform(_runs(nodes), lambda run: F.sha2(_join(run), 256))
    node = F.aggregate(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), _levels()), F.col("items.node"), up)[0]
    return found.select("key", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("place"), node.alias("node"))


def _step(nodes: Column, i: Column) -> Column:
    """What stands left and right of the node at i (from 0) of a run."""
    return F.struct(_join(F.slice(nodes, F.lit(1), i)).alias("left"), _join(F.slice(nodes, i + 2, F.lit(FANOUT))).alias("right"))


def opened(found: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """key, the columns carried, the items' columns and path of every item; found has above, the path from its block's node on."""
    found = found.select("*", _levels().alias("levels"), _runs(F.col("items")).alias("runs"))
    heads = F.transform("runs", lambda run: F.sha2(_join(run["node"]), 256))
    found = found.select("*", heads.alias("heads")).select("key", *carried, "above", "levels", "heads", F.posexplode("runs").alias("r", "run"))
    upper = F.when(F.col("levels") > 1, F.concat(F.array(_step(F.col("heads"), F.col("r"))), "above")).otherwise(F.col("above"))
    found = found.select("key", *carried, "levels", "run", upper.alias("above")).select("*", F.posexplode("run").alias("i", "item"))
    path = F.when(F.col("levels") > 0, F.concat(F.array(_step(F.col("run.node"), F.col("i"))), "above")).otherwise(F.col("above"))
    return found.select("key", *carried, "item.*", path.alias("path"))


def _rounds(nodes: DataFrame) -> int:
    """How often the largest key's nodes must be put into blocks until one is left."""
    n, rounds = nodes.agg(F.max("n")).first()[0] or 0, 1
    while n > BLOCK:
        n, rounds = -(-n // BLOCK), rounds + 1
    return rounds if n else 0


def climbed(nodes: DataFrame, payload: Sequence[str]) -> list[DataFrame]:
    """The blocks of every round, the leaves' first; the last has one block a key. Each is written, so that a lost executor costs its tasks only."""
    rounds: list[DataFrame] = []
    for k in range(_rounds(nodes)):
        rounds.append(stored(blocks(nodes, payload if k == 0 else ())))
        nodes = collapsed(rounds[-1])
    return rounds


def descended(rounds: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Every item of the first round with its path; tops has key, the columns carried and above, the path from the key's last node on."""
    found = rounds[-1].join(tops, "key")
    for below in rounds[-2::-1]:
        parents = opened(found, carried).select("key", *carried, F.col("place").alias("block"), F.col("path").alias("above"))
        found = below.join(parents, ["key", "block"])
    return opened(found, carried)


NO_PATH = "cast(array() as array<struct<left:string,right:string>>)"


def manifest(leaves: DataFrame, order: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """key, place, node, the payload, subroot, root and path of every leaf (key, node, the columns of order, the payload).

    Leaves of one key stand in the given order, nulls first, then by node; equal rows stay rows of
    their own. An empty table has no rows and no root.
    """
    kept = placed(stored(leaves), [*order, "node"])
    rounds = climbed(kept, payload)
    if not rounds:
        return kept.select("key", "place", "node", *payload, F.lit("").alias("subroot"), F.lit("").alias("root"), F.expr(NO_PATH).alias("path"))
    subroots = collapsed(rounds[-1]).select(F.lit("").alias("key"), F.col("key").alias("source_key"), "node")
    upper = climbed(placed(stored(subroots), ["source_key"]), ["source_key"])
    root = collapsed(upper[-1]).select("key", F.col("node").alias("root"), F.expr(NO_PATH).alias("above"))
    tops = descended(upper, root, ["root"])
    tops = tops.select(F.col("source_key").alias("key"), F.col("node").alias("subroot"), "root", F.col("path").alias("above"))
    return descended(rounds, tops, ["subroot", "root"])


def proof(path: Column) -> Column:
    """SHA-256 of a path's siblings, level by level, left to right."""
    return F.sha2(_join(F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


def folded(path: Column, node: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, node, lambda done, x: F.sha2(F.concat(x["left"], done, x["right"]), 256))


def tampered_leaf() -> Column:
    """The leaf of the row with its text's A-Z lower-cased where 5 divides the crc32 of doc_id, else null; a row without doc_id isn't tampered with."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return F.when(chosen, digest([changed if c == "text" else F.col(c) for c in FIELDS]))


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, place of every row of documents.

    place is the leaf's, from 0, in its source. Rows without a source are a source of their own, before
    all others. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(source_key(F.col("source")).alias("key"), "doc_id", digest([F.col(c) for c in FIELDS]).alias("node"), tampered_leaf().alias("tampered"))
    found = manifest(rows, ["doc_id"], ["doc_id", "tampered"])
    found = found.withColumn("folded_root", folded(F.col("path"), F.coalesce("tampered", "node")))
    return found.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "place",
    )


# ---------------------------------------------------------------- the same in SQL

#: Levels of either tree that the SQL goes up: enough for 16 ** 6 leaves a source and sources.
SQL_LEVELS = 6


def _sql_leaf(text: str) -> str:
    write = lambda c: f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || cast({c} as varchar), '-')"
    return "sha256(" + " || ".join(write(text if c == "text" else c) for c in FIELDS) + ")"


def _sql_tree(name: str) -> str:
    """From {name}0 (key, place, n, node): {name}k, the nodes of level k, and {name}p, their left and right siblings by level."""
    out = []
    for k in range(SQL_LEVELS):
        out.append(f"""{name}p{k} as (select key, place,
  case when n > 1 then coalesce(string_agg(node, '') over (w rows between unbounded preceding and 1 preceding), '') end as lft,
  case when n > 1 then coalesce(string_agg(node, '') over (w rows between 1 following and unbounded following), '') end as rgt
  from {name}{k} window w as (partition by key, place // 16 order by place))""")
        out.append(f"""{name}{k + 1} as (select key, place // 16 as place, (any_value(n) + 15) // 16 as n,
  case when any_value(n) > 1 then sha256(string_agg(node, '' order by place)) else any_value(node) end as node from {name}{k} group by key, place // 16)""")
    return ",\n".join(out)


def oracle() -> str:
    table = "list_transform(range(256), lambda i: list_reduce(range(8), lambda x, b: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, i))"
    crc = f"xor(4294967295, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)), lambda x, b: xor(x >> 8, ({table})[cast(xor(x, b) & 255 as int) + 1]), 4294967295))"
    steps = [("l", f"cast(floor(d.place / {16**k}) as bigint)", "d.key", k) for k in range(SQL_LEVELS)] + [("s", f"cast(floor(s0.place / {16**k}) as bigint)", "''", k) for k in range(SQL_LEVELS)]
    joins = "\n".join(f"join {t}p{k} on {t}p{k}.key = {key} and {t}p{k}.place = {place}" for t, place, key, k in steps)
    proof_ = " || ".join(f"coalesce({t}p{k}.lft || {t}p{k}.rgt, '')" for t, _, _, k in steps)
    fold = "case when tampered then changed else leaf end"
    folds = []
    for i, (t, _, _, k) in enumerate(steps):
        folds.append(f"f{i} as (select * exclude (x), case when lft{i} is null then x else sha256(lft{i} || x || rgt{i}) end as x from {'paths' if i == 0 else f'f{i - 1}'})")
    sides = ", ".join(f"{t}p{k}.lft as lft{i}, {t}p{k}.rgt as rgt{i}" for i, (t, _, _, k) in enumerate(steps))
    return f"""
with docs as (select doc_id, coalesce('=' || source, '') as key, {_sql_leaf('text')} as leaf,
  coalesce({crc} % 5 = 0, false) as tampered, {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} as changed from documents),
d as (select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by key) as n from docs),
l0 as (select key, place, n, leaf as node from d),
{_sql_tree('l')},
s0 as (select '' as key, row_number() over (order by key) - 1 as place, count(*) over () as n, node, key as source_key from l{SQL_LEVELS}),
{_sql_tree('s')},
paths as (select d.doc_id, d.leaf, d.place, s0.node as subroot, sha256({proof_}) as proof_sha256, {fold} as x, {sides}
  from d join s0 on s0.source_key = d.key {joins}),
{", ".join(folds)}
select doc_id, leaf, subroot, s{SQL_LEVELS}.node as root, proof_sha256, x as folded_root, x = s{SQL_LEVELS}.node as verified, cast(f{len(steps) - 1}.place as bigint) as place
from f{len(steps) - 1} cross join s{SQL_LEVELS}
"""
