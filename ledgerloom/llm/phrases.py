r"""Phrase collocation mining (operator 12).

Texts are lower-cased (A-Z) and split at `[.,;:!?\x0A-\x0D]` into pieces, those at spaces and tabs into words.
First every task counts the phrases of its texts in a sketch, one row of cells by hash;
Spark adds the tasks' sketches up, so a phrase's cell is an upper bound of its frequency. (A second row
would double what tasks send; one of twice the width passes about as few rare phrases.) Then every
task takes from each batch of its texts the phrases whose bound reaches the least frequency, compiles
them into an Aho-Corasick automaton and counts their overlapping matches in the batch. A pattern begins and
ends with the space that stands around every word of the rewritten text, so it matches whole words
only, and pieces are parted by a newline, so none crosses them. Spark sums the counts by phrase and keeps those
that reach the least frequency. Scores and the containment of phrases in longer ones are joins and groups.

Batches bound a task's memory; the sketch has a size that follows the texts', up to MOST cells, of which one bit
each is sent to the tasks. Beyond that more phrases pass the sketch and are counted in vain; results don't change.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import gram_hashes, runs, salted_join, span_hashes, stored

#: Words of a phrase, at most; candidates have two or more.
WORDS = 3
LEAST = 10
TOP = 2000
#: A phrase goes if a longer one that contains it has this share of its occurrences, in hundredths.
SHARE = 50

#: Cells of a sketch: a power of two above the texts' bytes / 16, within these bounds (a bit each is broadcast, 32 MB at most).
FEWEST, MOST = 1 << 17, 1 << 28
#: Cells that are summed and sent together.
SLICE = 1 << 17
#: Bytes of text that are hashed together, and of those that one automaton scans.
BATCH, SHARD = 1 << 20, 1 << 22

SMALL = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ENDS = bytes(0x0A if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in SMALL)
#: Words are runs of kind 1; kind 0 parts them.
KINDS = np.ones(256, dtype=np.uint8)
KINDS[[0x20, 0x0A]] = 0


def rewritten(text: bytes) -> bytes:
    r"""One line per piece: a space, the words with one space between, a space."""
    pieces = (b" ".join(piece.split()) for piece in text.translate(ENDS).split(b"\n"))
    return b"".join(b" " + piece + b" \n" for piece in pieces if piece)


def batches_by_lang(found: Iterator[pa.RecordBatch], limit: int = BATCH) -> Iterator[tuple[str, bytes]]:
    """(lang, rewritten texts behind one another) of about `limit` bytes; a longer text is one by itself."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in found:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            held.setdefault(lang, []).append(rewritten(text))
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= limit:
                yield lang, b"".join(held.pop(lang))
                size[lang] = 0
            elif sum(size.values()) >= 2 * limit:  # many languages with little text each
                for each in list(held):
                    yield each, b"".join(held.pop(each))
                size.clear()
    for lang, texts in held.items():
        yield lang, b"".join(texts)


class Words:
    """The words of rewritten texts, and the hashes of all phrases."""

    def __init__(self, lang: str, text: bytes):
        self.buffer = np.frombuffer(text, dtype=np.uint8)
        self.starts, self.ends = runs(self.buffer, KINDS) if text else (np.zeros(0, dtype=np.int64),) * 2
        piece = np.cumsum(self.buffer == 0x0A)
        self.piece = piece[self.starts] if len(self.starts) else self.starts
        seed = span_hashes(np.frombuffer(lang.encode() + b" ", dtype=np.uint8), np.array([0]), np.array([len(lang.encode())]))
        self.hashes = span_hashes(self.buffer, self.starts, self.ends) ^ seed if len(self.starts) else np.zeros(0, dtype=np.uint64)

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the first word, hash) of every phrase of n words inside a piece."""
        grams = gram_hashes(self.hashes, n)
        first = np.flatnonzero(self.piece[: len(grams)] == self.piece[n - 1 : n - 1 + len(grams)])
        return first, grams[first]


def cells(hashes: np.ndarray, width: int) -> np.ndarray:
    return (hashes & np.uint64(width - 1)).astype(np.int64)


def width_for(size: int) -> int:
    return min(MOST, max(FEWEST, 1 << max(size // 16, 1).bit_length()))


def sketched(texts: DataFrame, width: int, least: int, words: int) -> np.ndarray:
    """Bits of the sketch of texts (lang, text): whether a cell's count reaches `least`.

    A task sends slices of its cells, counts up to 255 (or as wide as `least` needs); a slice's sum stands as soon as
    all tasks' are added, which goes on batch by batch, so a task holds the sums of its slices only.
    """
    kind = np.uint8 if least <= 255 else np.uint32
    top = np.iinfo(kind).max

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(width, dtype=kind)
        for lang, text in batches_by_lang(found):
            seen = Words(lang, text)
            cell = np.sort(cells(np.concatenate([seen.phrases(n)[1] for n in range(1, words + 1)]), width).astype(np.uint32))
            if len(cell):
                first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                at, times = cell[first], np.diff(np.append(first, len(cell)))
                own[at] = np.minimum(own[at] + times.astype(np.uint64), top)
        for at in range(0, width, SLICE):
            part = own[at : at + SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // SLICE]), pa.array([zlib.compress(part, 1)])], names=["slice", "counts"])

    def add(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in found:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(counts), dtype=kind)
                sums[at] = np.minimum(sums[at] + part.astype(np.uint64), top).astype(kind) if at in sums else part
        for at, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([np.packbits(counts >= least).tobytes()])], names=["slice", "bits"])

    parts = texts.mapInArrow(count, "slice long, counts binary").repartition("slice").mapInArrow(add, "slice long, bits binary").toPandas()
    out = np.zeros((width // SLICE, SLICE // 8), dtype=np.uint8)
    for at, bits in zip(parts["slice"], parts["bits"], strict=True):
        out[at] = np.frombuffer(bits, dtype=np.uint8)
    return out.reshape(-1)


def reaches(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a phrase's upper bound reaches the least frequency."""
    cell = cells(hashes, 8 * len(bits))
    return (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1


class Shard:
    """Texts of one language: the phrases in them whose bound reaches the least frequency, and their counts by an automaton."""

    def __init__(self, lang: str, bits: np.ndarray, words: int):
        self.lang, self.bits, self.words = lang, bits, words
        self.texts: list[bytes] = []
        self.size = self.total = 0
        self.patterns: set[bytes] = set()

    def add(self, text: bytes) -> None:
        seen = Words(self.lang, text)
        self.texts.append(text)
        self.size += len(text)
        self.total += len(seen.starts)
        for n in range(1, self.words + 1):
            first, hashes = seen.phrases(n)
            some = np.flatnonzero(reaches(self.bits, hashes))
            _, one = np.unique(hashes[some], return_index=True)
            first = first[some[one]]
            for a, b in zip((seen.starts[first] - 1).tolist(), (seen.ends[first + n - 1] + 1).tolist(), strict=True):
                self.patterns.add(text[a:b])

    def counts(self) -> pa.RecordBatch:
        """key, f: the key is the language's length, `:`, the language and the phrase; the empty phrase carries the number of words."""
        found = [p.decode("utf-8", "surrogatepass") for p in self.patterns]
        times = np.zeros(len(found), dtype=np.int64)
        if found:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, p in enumerate(found):
                automaton.add_word(p, i)
            automaton.make_automaton()
            for text in self.texts:
                hits = np.fromiter((i for _, i in automaton.iter(text.decode("utf-8", "surrogatepass"))), dtype=np.int64)
                times += np.bincount(hits, minlength=len(found))
        head = f"{len(self.lang)}:{self.lang}"
        return pa.RecordBatch.from_arrays([pa.array([head, *(head + p[1:-1] for p in found)]), pa.array(np.append(self.total, times), pa.int64())], names=["key", "f"])


def shards(found: Iterator[pa.RecordBatch], bits: np.ndarray, words: int) -> Iterator[Shard]:
    """The texts in shards of about SHARD bytes of one language; all of them together hold less than twice that."""
    held: dict[str, Shard] = {}
    for lang, text in batches_by_lang(found):
        held.setdefault(lang, Shard(lang, bits, words)).add(text)
        if held[lang].size >= SHARD:
            yield held.pop(lang)
        elif sum(x.size for x in held.values()) >= 2 * SHARD:
            yield held.pop(max(held, key=lambda x: held[x].size))
    yield from held.values()


def counted(texts: DataFrame, bits: np.ndarray, least: int, words: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k words, f) of every phrase of up to `words` words with f >= least; and (lang, n), the words of each language."""

    def scan(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(found, bits, words):
            yield shard.counts()

    counts = texts.mapInArrow(scan, "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))
    size = F.substring_index("key", ":", 1)
    rest = F.substring("key", F.length(size) + 2, F.length("key"))
    counts = counts.select(F.substring(rest, F.lit(1), size.cast("int")).alias("lang"), F.substring(rest, size.cast("int") + 1, F.length("key")).alias("phrase"), "f")
    counts = stored(counts.filter((F.col("f") >= least) | (F.col("phrase") == "")))
    k = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1
    return counts.filter("phrase <> ''").withColumn("k", k), counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))


def _whole(c: str) -> Column:
    """A count as a decimal of 38 digits: products of counts up to 10^16 are exact."""
    return F.col(c).cast("decimal(38,0)")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, score of every candidate by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = counts.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    part = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    cuts = cuts.select("*", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    # a word that very many phrases begin or end with is a hot key
    for side, name in (("head", "l"), ("tail", "r")):
        times = cuts.groupBy("lang", side).agg(F.count("*").alias("n"))
        small = stored(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)).join(times, ["lang", side]))
        cuts = salted_join(cuts, small, ["lang", side], ["phrase", "cut"])
    score = F.expr("cast((cast(1000000 as decimal(38,0)) * a38 * a38) div (l38 * r38) as long)")
    cuts = cuts.withColumns({"a38": _whole("a"), "l38": _whole("l"), "r38": _whole("r")}).withColumn("score", score)
    low = F.min(F.struct("score", "cut", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "k", "a").agg(low).select("lang", "phrase", "k", "a", "low.l", "low.r", "low.score")


def contained(counts: DataFrame, words: int, share: int) -> DataFrame:
    """lang, phrase of the phrases inside a longer one that has `share` hundredths of their occurrences or more."""
    word = F.split("phrase", " ")
    spans = {k: [(a, b) for a, b in combinations(range(k + 1), 2) if 2 <= b - a < k] for k in range(3, words + 1)}
    inside = F.array()
    for k, found in spans.items():
        inside = F.when(F.col("k") == k, F.array(*[F.array_join(F.slice(word, a + 1, b - a), " ") for a, b in found])).otherwise(inside)
    longer = counts.filter("k > 2").select("lang", F.col("f").alias("longer"), F.explode(inside).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    near = counts.filter("k > 1").join(longer, ["lang", "phrase"])
    return near.filter(_whole("longer") * 100 >= _whole("f") * share).select("lang", "phrase")


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first phrases of 2 to `words` words by score.

    docs: lang (null: `und`) and text (null: empty); other columns are not read. Repeated rows count each. Ties
    go by frequency, then by phrase in the order of bytes. A language with no phrase of `least`
    occurrences has no rows; nor has an empty table.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = sketched(texts, width_for(size), least, words)
    counts, totals = counted(texts, bits, least, words)
    rows = scored(counts).join(contained(counts, words, share), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _sql_phrase(n: int) -> str:
    return f"select lang, array_to_string(w[i:i + {n - 1}], ' ') as phrase, {n} as k from (select lang, w, unnest(range(1, len(w) - {n - 2})) as i from p)"


ORACLE = rf"""
with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
u as (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from t),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from u),
f as (select lang, phrase, k, cast(count(*) as hugeint) as f from ({" union all ".join(_sql_phrase(n) for n in range(1, WORDS + 1))}) group by all),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as w from f where k > 1 and f >= {LEAST}),
cuts as (select *, unnest(range(1, k)) as cut from c),
s as (select cuts.lang, cuts.phrase, cuts.k, cuts.f, cuts.cut, x.f as l, y.f as r, (1000000 * cuts.f * cuts.f) // (x.f * y.f) as score from cuts
  join f x on x.lang = cuts.lang and x.phrase = array_to_string(cuts.w[1:cut], ' ')
  join f y on y.lang = cuts.lang and y.phrase = array_to_string(cuts.w[cut + 1:cuts.k], ' ')),
low as (select *, row_number() over (partition by lang, phrase order by score, cut) as o from s),
longer as (select lang, phrase, max(f) as f from (select lang, f, array_to_string(w[1:2], ' ') as phrase from c where k = 3
  union all select lang, f, array_to_string(w[2:3], ' ') from c where k = 3) group by all),
kept as (select low.* from low left join longer on longer.lang = low.lang and longer.phrase = low.phrase
  where o = 1 and not coalesce(100 * longer.f >= {SHARE} * low.f, false)),
ranked as (select *, row_number() over (partition by lang order by score desc, f desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, cast(f as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score
from ranked join n using (lang) where rank <= {TOP}
"""
