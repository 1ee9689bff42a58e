"""Benchmark decontamination (operator 3).

Words are runs of letters and digits with A-Z lower-cased. Every run of SEED words of a benchmark
item is a seed (an item with fewer words is one seed). A first pass over the corpus counts in how
many documents each seed occurs, summed in tasks before it is shuffled; an item's rare seeds are
those in at most RARE times as many documents as its median seed, so an item that was copied
everywhere keeps its seeds. A second pass finds the rare seeds only, with the words around them, and
Spark joins them with the items by seed. Around each joined seed a passage is cut, long enough for the
item with insertions, and aligned with it by Smith-Waterman on words; the score is the best local
alignment's share of the item's score with itself, so substituted, inserted and deleted words cost
in proportion.

What goes to every task is two filters of a fixed size (see bitmap in common), whatever the
benchmark's; a seed that passes by chance finds no item. Words around rare seeds are shuffled, not
documents, and the rows of a seed or an item that very many documents hold are dealt over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import NULL_ID, bitmap, chunks, cut, gram_hashes, id_key, in_bitmap, joined, runs, salted_join, span_hashes, text_or_empty, twin_key

#: Words of a seed, how much commoner than its item's median a rare one may be, the least score, and cells aligned at once.
SEED, RARE, THRESHOLD, BLOCK = 3, 8, 0.5, 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1

_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, and how many words each text has."""
    buffer, begins = joined(texts)
    starts, ends = runs(buffer, _KINDS)
    owner = np.searchsorted(begins, starts, side="right") - 1
    return span_hashes(_LOWER[buffer], starts, ends), np.bincount(owner, minlength=len(texts))


def margin(n: int) -> int:
    """Words that an item of n words may be off its seed's place by insertions and deletions."""
    return n // 2 + 2


def passages(places: np.ndarray, n_item: int, n: int) -> list[tuple[int, int]]:
    """(start, end) in a document of n words; places: where the item would begin by each seed. Those that meet are one."""
    out: list[list[int]] = []
    for d in np.sort(places).tolist():
        start, end = max(0, d - margin(n_item)), min(n, d + n_item + margin(n_item))
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each pair of word sequences, all pairs at once."""
    m, n = max(map(len, items), default=0), max(map(len, texts), default=0)
    a = np.zeros((len(items), m), dtype=np.int64)
    b = np.zeros((len(items), n), dtype=np.int64)
    for k, (x, y) in enumerate(zip(items, texts, strict=True)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    in_a = np.arange(m) < np.array([len(x) for x in items])[:, None]
    in_b = np.arange(n) < np.array([len(y) for y in texts])[:, None]
    slope = -GAP * np.arange(n + 1)
    h = np.zeros((len(items), n + 1), dtype=np.int32)
    best = np.zeros(len(items), dtype=np.int32)
    for i in range(m):
        same = (a[:, i : i + 1] == b) & in_b & in_a[:, i : i + 1]
        new = np.maximum(h + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], h[:, :-1] + np.where(same, MATCH, MISMATCH))
        h = np.maximum.accumulate(new + slope, axis=1) - slope  # gaps along the text
        best = np.maximum(best, h.max(axis=1))
    return best


def item_words(benchmark: DataFrame) -> DataFrame:
    """item (names a text under an id), item_id, words (array of hashes) of the items with words, repeated rows once."""
    slim = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct()
    slim = slim.select(F.xxhash64("item_id", "text").alias("item"), "item_id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for _, texts in chunks(batch.column("text").to_pylist()):
                words, counts = word_hashes(texts)
                made += np.split(words.view(np.int64), np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array(made, type=pa.list_(pa.int64()))], names=["item", "item_id", "words"])

    return slim.mapInArrow(run, "item long, item_id long, words array<long>").filter(F.size("words") > 0)


def seeds(items: DataFrame) -> DataFrame:
    """seed (hash), size (words), item, at (its place in the item), length (words of the item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[np.zeros(0, dtype=np.int64)] * 5]
            for item, words in zip(batch.column("item").to_pylist(), batch.column("words"), strict=True):
                words = words.values.to_numpy().view(np.uint64)
                size = min(len(words), SEED)
                found = gram_hashes(words, size).view(np.int64)
                full = lambda x: np.full(len(found), x, dtype=np.int64)  # noqa: B023, E731
                rows.append([found, full(size), full(item), np.arange(len(found)), full(len(words))])
            columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "size", "item", "at", "length"])

    return items.mapInArrow(run, "seed long, size long, item long, at long, length long")


def _hits(texts: list[bytes], sizes: list[int], bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, place, seed) of everything that may be a seed, and all texts' words and their ends."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    out = [(np.zeros(0, dtype=np.int64),) * 3]
    for size in sizes:
        found = gram_hashes(words, size).view(np.int64)
        p = np.flatnonzero(in_bitmap(bits, found))
        doc = np.searchsorted(ends, p, side="right")
        inside = p + size <= ends[doc] if len(p) else np.zeros(0, dtype=bool)
        out.append((doc[inside], p[inside], found[p[inside]]))
    return *(np.concatenate(x) for x in zip(*out, strict=True)), words.view(np.int64), ends


def seed_counts(slim: DataFrame, sizes: list[int], wanted: DataFrame) -> DataFrame:
    """seed, n: in how many rows of slim (text) each seed occurs."""
    shared = slim.sparkSession.sparkContext.broadcast(bitmap(wanted.select("seed"), "seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, dtype=np.int64)]
            for _, texts in chunks(batch.column("text").to_pylist()):
                doc, _, seed, _, _ = _hits(texts, sizes, shared.value)
                order = np.lexsort((doc, seed))
                doc, seed = doc[order], seed[order]
                first = np.ones(len(seed), dtype=bool)
                first[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
                found.append(seed[first])
            seed, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seed), pa.array(n)], names=["seed", "n"])

    return slim.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))


def surroundings(slim: DataFrame, sizes: list[int], rare: DataFrame, around: int) -> DataFrame:
    """key, twin, start, words, hits (array of seed, at): rare seeds in rows of slim (key, twin, text) with `around` words on either side.

    Those that meet are one row. start and at count a document's words from 0.
    """
    shared = slim.sparkSession.sparkContext.broadcast(bitmap(rare.select("seed"), "seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # copies with one doc_id in one task are sent once
        for batch in batches:
            keys, rows = list(zip(batch.column("key").to_pylist(), batch.column("twin").to_pylist(), strict=True)), []
            for first, texts in chunks(batch.column("text").to_pylist()):
                doc, place, seed, words, ends = _hits(texts, sizes, shared.value)
                order = np.lexsort((place, doc))
                doc, place, seed = doc[order], place[order], seed[order]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > 2 * around)
                edges = [*np.flatnonzero(new).tolist(), len(doc)]
                fresh: set[tuple[int, int]] = set()
                for i, j in zip(edges[:-1], edges[1:], strict=True):
                    d = int(doc[i])
                    key = keys[first + d]
                    if key in seen:
                        continue
                    fresh.add(key)
                    begin = int(ends[d - 1]) if d else 0
                    start, end = max(begin, int(place[i]) - around), min(int(ends[d]), int(place[j - 1]) + around + SEED)
                    rows.append((*key, start - begin, words[start:end], seed[i:j], place[i:j] - begin))
                seen |= fresh
            columns = list(zip(*rows, strict=True)) or [()] * 6
            longs = pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int64(), longs, longs, longs)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=["key", "twin", "start", "words", "seeds", "places"])

    return slim.mapInArrow(run, "key long, twin long, start long, words array<long>, seeds array<long>, places array<long>")


def _cut_out(found: DataFrame) -> DataFrame:
    """key, twin, item, start, end, words: passages of found (key, twin, start, words, item, length, begins)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("key", "twin", "item", "start", "length", "begins")]
            for k, (key, twin, item, start, length, begins) in enumerate(zip(*columns, strict=True)):
                words = batch.column("words")[k].values.to_numpy()
                for a, b in passages(np.array(begins, dtype=np.int64) - start, length, len(words)):
                    rows.append((key, twin, item, start + a, start + b, words[a:b]))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(),) * 5 + (pa.list_(pa.int64()),)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=["key", "twin", "item", "start", "end", "words"])

    return found.mapInArrow(run, "key long, twin long, item long, start long, end long, words array<long>")


def _scored(pairs: DataFrame, block: int) -> DataFrame:
    """key, twin, item_id, start, end, score of pairs, which also have words and item_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [x.values.to_numpy() for x in batch.column("item_words")]
            texts = [x.values.to_numpy() for x in batch.column("words")]
            score = np.zeros(len(items))
            order = sorted(range(len(items)), key=lambda i: len(texts[i]))
            at = 0
            while at < len(order):  # pairs of like lengths together
                own = order[at : at + max(1, block // (len(texts[order[min(at + 511, len(order) - 1)]]) + 1))][:512]
                score[own] = align([items[i] for i in own], [texts[i] for i in own]) / [MATCH * len(items[i]) for i in own]
                at += len(own)
            names = ["key", "twin", "item_id", "start", "end"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(score)], names=[*names, "score"])

    return pairs.mapInArrow(run, "key long, twin long, item_id long, start long, end long, score double")


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, block: int) -> DataFrame:
    """key, twin, item_id, b (score, -start, -end of the best passage) of the documents that reach threshold."""
    items = cut(item_words(benchmark))
    every = cut(seeds(items))
    known = every.agg(F.sort_array(F.collect_set("size")).alias("sizes"), F.coalesce(F.max("length"), F.lit(0)).alias("longest")).first()  # up to SEED sizes
    slim = docs.select(id_key().alias("key"), twin_key().alias("twin"), text_or_empty().cast("binary").alias("text"))
    counts = every.join(cut(seed_counts(slim, known.sizes, every)), "seed")
    median = counts.groupBy("item").agg((RARE * F.percentile("n", F.lit(0.5))).alias("most"))
    rare = cut(counts.join(median, "item").filter("n <= most").select("seed", "n", "item", "at", "length"))
    around = cut(surroundings(slim, known.sizes, rare, known.longest + margin(known.longest)))
    where = ["key", "twin", "start"]
    hits = around.select(*where, F.explode(F.arrays_zip("seeds", "places")).alias("x")).select(*where, F.col("x.seeds").alias("seed"), F.col("x.places").alias("place"))
    hits = salted_join(hits, rare, ["seed"], where)
    begins = hits.groupBy(*where, "item", "length").agg(F.collect_set(F.col("place") - F.col("at")).alias("begins"))
    once = around.groupBy(*where).agg(F.first("words").alias("words"))
    texts = salted_join(_cut_out(begins.join(once, where)), _by_item(items, rare), ["item"], where)
    best = F.max(F.struct("score", (-F.col("start")).alias("start"), (-F.col("end")).alias("end"))).alias("b")
    return _scored(texts, block).filter(F.col("score") >= threshold).groupBy("key", "twin", "item_id").agg(best)


def _by_item(items: DataFrame, rare: DataFrame) -> DataFrame:
    """item, item_id, item_words, n: in how many documents its commonest rare seed is."""
    return cut(rare.groupBy("item").agg(F.max("n").alias("n")).join(items.withColumnRenamed("words", "item_words"), "item"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, score, start, end (words): each document and item whose best passage reaches threshold.

    Null and empty texts and items match nothing. Rows that share a doc_id, or have none, and unlike
    texts are documents of their own; rows that repeat both are one. Of benchmark rows that share an
    item_id, or have none, each text is searched for, and the best counts. Empty tables give none.
    """
    found = _found(docs, benchmark, threshold, block)
    key = F.when(F.col("key") != F.lit(NULL_ID), F.col("key"))
    return found.select(key.alias("doc_id"), "item_id", F.col("b.score").alias("score"), (-F.col("b.start")).alias("start"), (-F.col("b.end")).alias("end"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs without the contaminated documents.

    Each row is judged by its own text: one that shares its doc_id, or the lack of one, with a
    contaminated row stays. Null and empty texts stay. Empty tables give none, or all rows.
    """
    bad = cut(_found(docs, benchmark, threshold, BLOCK).select("key", "twin").distinct())
    rows = docs.select(F.struct("*").alias("row"), id_key().alias("key"), twin_key().alias("twin"))
    return rows.join(bad, ["key", "twin"], "left_anti").select("row.*")
