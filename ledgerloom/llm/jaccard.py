"""N-gram Jaccard join (operator 9).

A document's set holds its distinct runs of five words. Two sets are joined when their Jaccard
similarity is 0.8 or more, that is when their Jaccard distance, a metric, is 0.2 or less. Equal sets
are one node, named by 64 bits of a hash of their elements' 64-bit hashes; so exact means here that
no two of those hashes collide. Shingle sets of unrelated documents are all at distance 1 from one
another, and there pivots tell nothing apart, so the join has two levels, both exact:

1. Regions. Of a set of n shingles at most s = n // 5 are missing from a set that it is joined
   with. So with the s + k smallest hashes of each set, a joined pair shares at least the lesser
   of its two k, here a tenth of n. Sets with fewer hashes that any other set holds are dropped, twice over,
   and each remaining set is indexed by its rarest sampled hashes, all but the k - 1 most common
   (two joined sets still share one). Sets that share an indexed hash are of one region. A region
   beyond the bound of a cell is first parted by the rarest elements of its whole sets, since
   passages in common may have made it large.
2. Pivots and Voronoi cells. In every region, whatever its size, each set's distances to a few pivots are
   found. Sets within 0.2 of a pivot are linked with it, and pivots that share such a set are of one
   component, the largest of which is settled: its sets need no comparison with one another. Every
   other set is a core of the cell of its nearest pivot; cores more than 0.6 from all are a cell of
   their own. By the triangle inequality what is joined with a core has a distance to the cell's pivot
   within 0.2 of the core's, so all sets in that window are copied to the cell, and no link is lost.
   A cell beyond the bound is cut again with pivots of its own; what is still too large after CUTS
   times is dealt out as pairs of blocks. Inside a cell one task goes on in the same way, pivot by
   pivot, with windows around each.

Links are kept as stars, not as all pairs, since the result is the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bitmap, chunks, cut, gram_hashes, id_key, in_bitmap, joined, runs, salted_join, slices, span_hashes, stored, sweep, text_or_empty, twin_key

N, PERCENT = 5, 80
#: Bound of a cell: sets, and elements of all its sets (8 bytes each). Regions of more than REFINE sets are parted by whole sets before they are cut.
CELL, ELEMENTS, REFINE = 2_000, 4_000_000, 2_000
#: Most pivots of a cut (at most 16), and how often cells are cut again.
PIVOTS, CUTS = 8, 2
#: Distance within which sets are joined, and beyond which a core is in no pivot's cell.
RADIUS, FAR, EPS = (100 - PERCENT) / 100, 0.6, 1e-9

#: Bytes of texts whose sets are made together; their arrays take many times that.
SOME = 1 << 18

_KINDS = np.ones(256, dtype=np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """Each text's distinct n-word shingles as sorted hashes; fewer words are one shingle, none are an empty set."""
    buffer, begins = joined(texts)
    starts, ends = runs(buffer, _KINDS)
    words = span_hashes(_LOWER[buffer], starts, ends)
    counts = np.bincount(np.searchsorted(begins, starts, side="right") - 1, minlength=len(texts))
    grams, out, at = gram_hashes(words, n), [], 0
    for c in counts.tolist():
        own = grams[at : at + c - n + 1] if c >= n else gram_hashes(words[at : at + c], c) if c else grams[:0]
        out.append(np.unique(own))
        at += c
    return out


def name(hashes: np.ndarray) -> int:
    """The 64-bit name of a set, from its sorted elements."""
    return int.from_bytes(hashlib.md5(hashes.tobytes()).digest()[:8], "little", signed=True)


def slack(n: int) -> int:
    """The most shingles of a set of n that a joined set lacks."""
    return n - -(-n * PERCENT // 100)


def shared(n: int) -> int:
    """k of a set of n: what is sampled beyond the slack."""
    return max(1, -(-n // 10))


def least_shared(n: int) -> int:
    """The least number of sampled hashes that a set of n shares with a joined set, which has 80 % of n at least."""
    return shared(-(-n * PERCENT // 100))


# ---------------------------------------------------------------- the join inside a task


class Groups:
    """Components of what has been linked."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def all(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


class Sets:
    """Sets behind one another, with their elements numbered."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.end = np.cumsum(self.size)
        values = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        known, self.number = np.unique(values, return_inverse=True)
        self.universe = len(known)
        self.owner = np.repeat(np.arange(len(sets)), self.size)

    def prefixes(self) -> None:
        """Of each set the slack + 1 elements that the fewest sets hold: joined sets share one of those."""
        df = np.bincount(self.number, minlength=self.universe)
        rank = np.empty(self.universe, dtype=np.int64)
        rank[np.lexsort((np.arange(self.universe), df))] = np.arange(self.universe)
        order = np.lexsort((rank[self.number], self.owner))
        place = np.arange(len(order)) - np.repeat(self.end - self.size, self.size)
        most = np.array([slack(n) for n in self.size.tolist()], dtype=np.int64)
        keep = order[(place <= most[self.owner[order]]) & (df[self.number[order]] > 1)]
        self.pre, self.pre_end = self.number[keep], np.cumsum(np.bincount(self.owner[keep], minlength=len(self.size)))
        by = np.argsort(self.pre, kind="stable")
        self.held, self.held_end = self.owner[keep][by], np.cumsum(np.bincount(self.pre, minlength=self.universe))

    def sharing(self, i: int) -> np.ndarray:
        """The sets with a prefix element of set i, itself among them."""
        own = self.pre[self.pre_end[i - 1] if i else 0 : self.pre_end[i]].tolist()
        found = [self.held[self.held_end[e - 1] if e else 0 : self.held_end[e]] for e in own]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def one(self, i: int) -> np.ndarray:
        return self.number[self.end[i] - self.size[i] : self.end[i]]

    def common(self, i: int) -> np.ndarray:
        """Elements that each set has in common with set i."""
        mark = np.zeros(self.universe, dtype=np.float64)
        mark[self.one(i)] = 1
        return np.bincount(self.owner, weights=mark[self.number], minlength=len(self.size)).astype(np.int64)


    def common_with(self, i: int, others: np.ndarray) -> np.ndarray:
        """The same, of some sets only."""
        mark = np.zeros(self.universe, dtype=bool)
        mark[self.one(i)] = True
        return np.array([np.count_nonzero(mark[self.one(j)]) for j in others.tolist()], dtype=np.int64)


def near(common: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
    """Whether two sets of sizes a and b with so many elements in common are joined."""
    return 100 * common >= PERCENT * (a + b - common)


def components(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the first one of its component; exact.

    Pivots are taken one by one, first from the largest group of sets that aren't settled. A set is
    settled once it has been a pivot. Only sets are looked at that share one of its rare elements,
    are of like size, lie at a like distance from the first pivots (triangle inequality), and are
    not in its component already. When all outside the largest component are settled, so is that.
    """
    x, groups = Sets(sets), Groups(len(sets))
    n = len(sets)
    if n < 2:
        return groups.all()
    x.prefixes()
    known: list[np.ndarray] = []  # distances to the first pivots, in millionths
    done = np.zeros(n, dtype=bool)
    label = groups.all()
    while True:
        main = np.bincount(label).argmax()
        rest = np.flatnonzero(~done & (label != main))
        if not len(rest):
            return label
        # the first pivot is the set with the most common elements; then sets outside the main component
        i = int(np.bincount(x.owner, weights=np.bincount(x.number)[x.number]).argmax()) if not done.any() else int(rest[0])
        done[i] = True
        could = x.sharing(i)
        could = could[(label[could] != label[i]) & (100 * np.minimum(x.size[could], x.size[i]) >= PERCENT * np.maximum(x.size[could], x.size[i]))]
        for d in known:
            could = could[np.abs(d[could] - d[i]) <= 200_001]
        if not len(could):
            continue
        if len(known) < 8:
            common = x.common(i)
            known.append(1e6 * (1 - common / (x.size + x.size[i] - common)))
            common = common[could]
        else:
            common = x.common_with(i, could)
        hit = could[near(common, x.size[could], x.size[i])]
        if len(hit):
            for j in np.unique(label[hit]).tolist():
                groups.link(i, j)
            label = groups.all()


# ---------------------------------------------------------------- the join on Spark


def sampled(docs: DataFrame) -> DataFrame:
    """doc_id, key, twin, n, node, pre: the s + k smallest hashes, of every row of docs (doc_id, text); node is null for an empty set."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_key().alias("key"), twin_key().alias("twin"), text_or_empty().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for first, texts in chunks(batch.column("text").to_pylist(), SOME):
                sets = shingle_sets(texts)
                pre = [s[: slack(len(s)) + shared(len(s))].view(np.int64) for s in sets]
                columns = [
                    *(batch.column(c).slice(first, len(sets)) for c in ("doc_id", "key", "twin")),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([name(s) if len(s) else None for s in sets], type=pa.int64()),
                    pa.array(pre, type=pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "twin", "n", "node", "pre"])

    return slim.mapInArrow(run, "doc_id long, key long, twin long, n long, node long, pre array<long>")


def min_labels(edges: DataFrame) -> DataFrame:
    """a, label: for every node of edges (a, b) the smallest node that it reaches.

    Each round ties a node's larger neighbours to the smallest of it and its neighbours (large star), then a node
    and its smaller neighbours to the smallest of those (small star). Both keep what is connected, and each edge
    becomes one edge, so a round has no more rows than the one before, and no join makes rows. Rounds end when one
    moved nothing: only stars are left, whose centres are their smallest nodes. Equal edges meet at the end of a round only,
    and each edge says itself whether it moved, so that a round is three shuffles.
    """
    pairs = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    smallest = F.first("b").over(Window.partitionBy("a").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pair = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
    stars = pairs.filter("a <> b")
    while True:
        both = stars.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("e")).select("e.a", "e.b")
        large = both.withColumn("m", F.least("a", smallest)).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"), (F.col("m") < F.col("a")).alias("moved"))
        stays = F.col("b") == F.col("m")
        small = large.withColumn("m", smallest).select(F.when(stays, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"), (F.col("moved") | ~stays).alias("moved"))
        stars = cut(small.groupBy("a", "b").agg(F.bool_or("moved").alias("moved")))
        sweep(edges.sparkSession)
        if stars.filter("moved").isEmpty():
            break
    found = stars.select(F.explode(F.array(pair("a", "b"), pair("b", "b"))).alias("e")).select("e.a", "e.b").unionByName(pairs.filter("a = b"))
    return cut(found.groupBy("a").agg(F.min("b").alias("label")))


def least(n: str = "n") -> Column:
    """least_shared of a column."""
    return F.greatest(F.lit(1), F.ceil(F.ceil(F.col(n) * PERCENT / 100) / 10)).cast("long")


def candidate_edges(rows: DataFrame) -> DataFrame:
    """a, b: stars of sets that share an indexed hash, some more than once. rows: key, n, pre, one row per distinct set.

    Windows over a hash only look at the row before or behind; those over a key hold one set's hashes.
    """
    held = rows.select("key", F.col("n").cast("int").alias("n"), F.explode("pre").alias("h"))
    own = Window.partitionBy("key")
    for _ in range(2):
        by = Window.partitionBy("h").orderBy("key")
        held = held.withColumn("other", F.coalesce(F.lag("key").over(by), F.lead("key").over(by))).filter("other is not null").drop("other")
        held = stored(held.withColumn("m", F.count("*").over(own)).filter(F.col("m") >= least()).select("key", "n", "h"))
    df = held.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    # of a set's sampled hashes all but the k - 1 most common; those that no other set holds are the rarest
    order = own.orderBy(F.desc("df"), F.desc("h"))
    kept = held.join(df, "h").withColumn("place", F.row_number().over(order)).filter(F.col("place") >= least()).select("key", "h")
    first = Window.partitionBy("h").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return kept.withColumn("hub", F.first("key").over(first)).filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))


def full_sets(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """region, key, hashes: the whole set of every node in regions (key: the node, region, doc: a document that holds it).

    Tasks make the sets of documents that the bitmap lets through, so sets are shuffled, not texts.
    """
    doc = F.xxhash64(id_key(), twin_key()).alias("key")
    slim = docs.select(doc, text_or_empty().cast("binary").alias("text"))
    shared_bits = docs.sparkSession.sparkContext.broadcast(bitmap(regions, "doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared_bits.value, set()
        for batch in slices(batches):
            batch = batch.filter(pa.array(in_bitmap(bits, batch.column("key").to_numpy())))
            for _, texts in chunks(batch.column("text").to_pylist(), SOME):
                sets = {name(s): s.view(np.int64) for s in shingle_sets(texts) if len(s)}
                new = [k for k in sets if k not in seen]  # copies in one task are sent once
                seen.update(new)
                yield pa.RecordBatch.from_arrays([pa.array(new, type=pa.int64()), pa.array([sets[k] for k in new], type=pa.list_(pa.int64()))], names=["key", "hashes"])

    sets = slim.mapInArrow(run, "key long, hashes array<long>")
    return sets.join(regions.select("key", "region"), "key").groupBy("region", "key").agg(F.first("hashes").alias("hashes"))


def finer(docs: DataFrame, large: DataFrame) -> DataFrame:
    """key, region, n, doc: large regions (key, region, n, doc) cut by the whole sets of their nodes.

    Joined sets share one of the s + 1 elements of each that the fewest sets of the region hold, so
    sets that share none of those are parted, and those that share none with any have no link.
    """
    held = full_sets(docs, large).select("region", "key", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    df = Window.partitionBy("region", "h").orderBy("key")
    held = held.withColumn("other", F.coalesce(F.lag("key").over(df), F.lead("key").over(df))).filter("other is not null")
    held = stored(held.select("region", "key", "n", "h"))
    counts = held.groupBy("region", "h").agg(F.count("*").alias("df"))
    order = Window.partitionBy("region", "key").orderBy("df", "h")
    place = F.row_number().over(order)
    many = F.count("*").over(Window.partitionBy("region", "key"))
    most = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - F.col("n") + many  # of those that others hold too
    kept = held.join(counts, ["region", "h"]).withColumn("place", place).withColumn("most", most).filter("place <= most").select("region", "key", "h")
    first = Window.partitionBy("region", "h").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = kept.withColumn("hub", F.first("key").over(first)).filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    labels = min_labels(edges).select(F.col("a").alias("key"), F.col("label").cast("string").alias("region"))
    return labels.join(large.drop("region"), "key")


def sizes(sets: DataFrame) -> DataFrame:
    """region, n (sets), elements."""
    return sets.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.size("hashes").cast("long")).alias("elements"))


def too_large(cell: int, elements: int) -> Column:
    return (F.col("n") > cell) | ((F.col("elements") > elements) & (F.col("n") > 1))


def pivot_sets(sets: DataFrame, large: DataFrame, cell: int, elements: int, level: int) -> DataFrame:
    """region, n, pivots (array of p, key, hashes): of each large region one set of each of up to PIVOTS parts, picked by hash."""
    wanted = F.least(F.lit(PIVOTS), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / cell), F.ceil(2 * F.col("elements") / elements))).cast("int")
    order = F.xxhash64("key", F.lit(level))
    rows = sets.select("region", "key").join(large.withColumn("wanted", wanted).select("region", "wanted"), "region")
    picked = rows.groupBy("region", F.pmod(order, F.col("wanted")).alias("p")).agg(F.min(F.struct(order.alias("o"), "key"))["key"].alias("key"))
    own = sets.join(picked, ["region", "key"]).groupBy("region").agg(F.collect_list(F.struct("p", "key", "hashes")).alias("pivots"))
    return own.join(large.select("region", "n"), "region")


def distances(sets: DataFrame, pivots: DataFrame) -> DataFrame:
    """region, key, d (distance to each pivot of its region), mask (bits of the pivots within RADIUS), near (place of the nearest), best (its distance)."""
    rows = salted_join(sets, pivots, ["region"], ["key"])  # PIVOTS sets a row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list] = {}
            d = []
            for k, region in enumerate(batch.column("region").to_pylist()):
                if region not in held:
                    held[region] = [np.sort(np.array(x["hashes"], dtype=np.int64)) for x in batch.column("pivots")[k].as_py()]
                own = batch.column("hashes")[k].values.to_numpy()
                common = [len(np.intersect1d(own, x, assume_unique=True)) for x in held[region]]
                d.append([1 - c / (len(own) + len(x) - c) for c, x in zip(common, held[region], strict=True)])
            mask = [sum(1 << i for i, x in enumerate(v) if x <= RADIUS + EPS) for v in d]
            near_ = [int(np.argmin(v)) for v in d]
            columns = [batch.column("region"), batch.column("key"), pa.array(d, type=pa.list_(pa.float64())), pa.array(mask, type=pa.int32()), pa.array(near_, type=pa.int32()), pa.array([min(v) for v in d], type=pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["region", "key", "d", "mask", "near", "best"])

    return rows.mapInArrow(run, "region string, key long, d array<double>, mask int, near int, best double")


def settled(far: DataFrame) -> DataFrame:
    """region, main: the bits of the pivots of each region's largest component. far: what distances gives."""
    masks = far.filter("mask > 0").groupBy("region", "mask").agg(F.count("*").alias("m"))
    rows = masks.groupBy("region").agg(F.collect_list(F.struct("mask", "m")).alias("masks"))  # 2 ** PIVOTS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for masks in batch.column("masks").to_pylist():
                groups: dict[int, int] = {}
                for x in masks:
                    mask, m = x["mask"], x["m"]
                    for other in [g for g in groups if g & mask]:
                        mask, m = mask | other, m + groups.pop(other)
                    groups[mask] = m
                out.append(max(groups, key=lambda g: (groups[g], -g)))  # noqa: B023
            yield pa.RecordBatch.from_arrays([batch.column("region"), pa.array(out, type=pa.int32())], names=["region", "main"])

    return rows.mapInArrow(run, "region string, main int")


def voronoi(sets: DataFrame, large: DataFrame, cell: int, elements: int, level: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of sets with pivots, and the cells of large regions: region, key, hashes of cores and of what may be joined with one."""
    pivots = cut(pivot_sets(sets, large, cell, elements, level))
    sweep(sets.sparkSession)
    far = cut(distances(sets, pivots))
    sweep(sets.sparkSession)
    keys = pivots.select("region", F.posexplode(F.col("pivots")["key"]).alias("i", "pivot"))
    links = far.filter("mask > 0").select("region", "key", "mask").join(keys, "region").filter("(shiftright(mask, i) & 1) = 1 and key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    cores = far.join(settled(far), "region", "left").filter("mask & coalesce(main, 0) = 0")
    alone = F.col("best") > FAR
    cores = cores.select("region", F.when(alone, -1).otherwise(F.col("near")).alias("cell"), "best")
    windows = cores.groupBy("region", "cell").agg((F.min("best") - RADIUS - EPS).alias("low"), (F.max("best") + RADIUS + EPS).alias("high"))
    at = F.when(F.col("cell") < 0, F.col("best")).otherwise(F.get("d", F.col("cell")))
    inside = F.when(F.col("cell") < 0, F.col("best") >= F.col("low")).otherwise(at.between(F.col("low"), F.col("high")))
    cells = far.join(windows, "region").filter(inside).select("region", "key", "cell")
    sets = sets.join(cells, ["region", "key"])
    return links, sets.select(F.concat_ws("/", "region", F.col("cell").cast("string")).alias("region"), "key", "hashes")


def blocks(sets: DataFrame, large: DataFrame, cell: int, elements: int) -> DataFrame:
    """Regions that no cut makes smaller, as pairs of blocks: every two sets of a region meet in a pair that fits a task."""
    n = F.ceil(F.greatest(F.col("n") * 2 / cell, F.col("elements") * 2 / elements)).cast("int")
    rows = salted_join(sets, large.select("region", "n", n.alias("blocks")), ["region"], ["key"])
    rows = rows.withColumn("t", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.concat_ws("/", "region", F.least("t", "u").cast("string"), F.greatest("t", "u").cast("string"))
    return rows.select(pair.alias("region"), "key", "hashes")


def join_regions(sets: DataFrame, cell: int = CELL, elements: int = ELEMENTS, cuts: int = CUTS) -> DataFrame:
    """a, b: links that give the components of sets (region, key, hashes)."""

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        first = components([np.array(h, dtype=np.int64).view(np.uint64) for h in pdf["hashes"]])
        keys = pdf["key"].to_numpy()
        moved = np.flatnonzero(first != np.arange(len(first)))
        return pd.DataFrame({"a": keys[moved], "b": keys[first[moved]]})

    done: list[DataFrame] = []
    links: list[DataFrame] = []
    for level in range(cuts + 1):
        # every region is cut by pivots once, and again where it is beyond the bound
        large = cut(sizes(sets).filter(too_large(cell, elements) if level else F.lit(True)))
        if large.isEmpty():
            break
        done.append(sets.join(large, "region", "left_anti"))
        sets = sets.join(large.select("region"), "region", "left_semi")
        if level == cuts:
            sets = blocks(sets, large, cell, elements)
            break
        linked, sets = voronoi(sets, large, cell, elements, level)
        links.append(linked)
        sets = cut(sets)
        sweep(sets.sparkSession)
    every = sets
    for other in done:
        every = every.unionByName(other)
    found = every.groupBy("region").applyInPandas(link, "a long, b long")
    for other in links:
        found = found.unionByName(other)
    return found


def near_copies(docs: DataFrame, cell: int = CELL, refine: int = REFINE, elements: int = ELEMENTS) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, key, twin, n, node) of docs, and nodes (node, n: rows, component_id, first: the component's first (no_id, key, twin))."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(sampled(docs))
    nodes = rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("pre").alias("pre"))
    edges = candidate_edges(nodes.select(F.col("node").alias("key"), "n", "pre"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "key", "twin")
    held = cut(rows.filter("n > 0").groupBy("node").agg(F.count("*").alias("n"), F.first("n").alias("size"), F.min("doc_id").alias("id"), F.min(first).alias("first")))
    regions = min_labels(edges).select(F.col("a").alias("key"), F.col("label").cast("string").alias("region"))
    doc = F.xxhash64("first.key", "first.twin").alias("doc")
    regions = cut(regions.join(held.select(F.col("node").alias("key"), F.col("size").alias("n"), doc), "key"))
    sweep(docs.sparkSession)
    counts = regions.groupBy("region").agg(F.count("*").alias("n"), F.sum("n").alias("elements"))
    counts = cut(counts.filter(too_large(min(cell, refine), elements)))
    large = counts.filter(too_large(refine, elements)).select("region")
    if not counts.isEmpty():
        regions = cut(regions.join(large, "region", "left_anti").unionByName(finer(docs, regions.join(large, "region", "left_semi")).select(regions.columns)))
    sets = cut(full_sets(docs, regions))
    sweep(docs.sparkSession)
    labels = min_labels(join_regions(sets, cell, elements)).withColumnRenamed("a", "node")
    nodes = cut(held.join(labels, "node", "left").select("node", "n", "id", "first", F.coalesce("label", "node").alias("label")))
    classes_ = cut(nodes.groupBy("label").agg(F.count("*").alias("n"), F.min("id").alias("component_id"), F.min("first").alias("first")))
    nodes = salted_join(nodes.select("node", F.col("n").alias("rows"), "label"), classes_, ["label"], ["node"])
    return rows.select("doc_id", "key", "twin", "n", "node"), cut(nodes.select("node", F.col("rows").alias("n"), "component_id", "first"))


def classes(docs: DataFrame, cell: int = CELL, refine: int = REFINE, elements: int = ELEMENTS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A null or blank text has an empty set and is linked with nothing; its component is its own id.
    Every row is a document of its own, with or without a doc_id, and rows that share one are not
    linked by that. component_id is the smallest doc_id of the rows in the component; rows without
    one don't count there, so it is null where none has one. An empty table gives none.
    """
    rows, nodes = near_copies(docs, cell, refine, elements)
    n_shingles = F.col("n").alias("n_shingles")
    full = salted_join(rows.filter("n > 0").select("doc_id", "twin", n_shingles, "node"), nodes.drop("first"), ["node"], ["doc_id", "twin"])
    empty = rows.filter("n = 0").select("doc_id", n_shingles, F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").unionByName(empty)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the first of their component, and all that have no words.

    The first is that of the smallest doc_id, rows without one last, ties by the hash of the text.
    Rows that repeat doc_id and text of the first are that document and stay with it; of rows
    without a doc_id that repeat a text one stays. Rows are judged each by itself, so that no row
    goes because another with its doc_id does. An empty table gives none.
    """
    rows, nodes = near_copies(docs.select("doc_id", "text"))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "key", "twin")
    found = salted_join(rows.filter("n > 0"), nodes.drop("component_id"), ["node"], ["key", "twin"])
    gone = cut(found.filter(own != F.col("first")).select("key", "twin").distinct())
    left = docs.select(F.struct("*").alias("row"), id_key().alias("key"), twin_key().alias("twin")).join(gone, ["key", "twin"], "left_anti")
    # of rows without a doc_id those with one text are copies; texts without words stay
    alone = F.col("row.doc_id").isNull() & F.coalesce(F.col("row.text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = left.filter(alone).groupBy("twin").agg(F.first("row").alias("row"))
    return left.filter(~alone).select("row").unionByName(once.select("row")).select("row.*")


ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i from w)),
n as (select doc_id, count(*) as n from s group by 1),
shared as (select g from s group by 1 having count(*) > 1),
t as (select s.* from s join shared using (g)),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
edges as (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id as r from n union select reach.doc_id, edges.b from reach join edges on edges.a = reach.r)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m.m, d.doc_id) as component_id from documents d left join n using (doc_id) left join (select doc_id, min(r) as m from reach group by 1) m using (doc_id)
"""
