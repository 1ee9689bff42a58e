"""Suffix-array dedup (operator 2): every byte that a THRESHOLD-byte string covers which starts earlier goes.

Prefix doubling ranks positions by ever longer prefixes until a rank is unique or long enough. Here
a rank is a 64-bit hash, so a task makes the ranks of 1, 2, 4, ... bytes at all positions of its
texts by itself, each from a pair of the one before, and Spark sorts pairs only where a longer
prefix must be compared between documents:

1. Ranks of GRAM bytes. The positions whose string of THRESHOLD bytes has its smallest such rank
   at one place are a segment. Equal strings have equal smallest ranks, so only segments with the
   same one can share a string; about 1 in 35 positions begins a segment, and only segments are sorted.
2. Spark sorts (smallest rank, rank of the segment's whole text, doc_id, position). A segment with
   an equal one before it is repeated. One that is alone with its smallest rank is unique and done.
3. What is left, segments of unlike texts with the same smallest rank, is cut into blocks of
   BLOCK positions, counted from the place of that rank. All strings of a block share all but
   BLOCK - 1 of their bytes; Spark sorts (rank of those, rank of the block's whole text, doc_id,
   position) as before: equal blocks are repeated, and blocks alone with the bytes that they share are
   done, so short lines that recur in ever other places end here.
4. The rest goes on position by position: Spark sorts (rank of 64 bytes, rank of the 64 bytes from
   THRESHOLD - 64 on, doc_id, position), and a position with an equal pair before it is repeated.

Sorting compares a row with the one before it, so no group is held, however large. Rows that a
batch shows to be repeated already, as in copies and common passages, are settled there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import NULL_ID, chunks, cut, id_key, joined, mix, span_hashes, twin_key

THRESHOLD, GRAM, BLOCK = 100, 32, 10

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x9E3779B185EBCA87, 0xD6E8FEB86659FD93]


def doubled(buffer: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the `size` bytes (a power of two, 64 at most) from each position on."""
    rank, n = _BYTE[buffer], 1
    for odd in _ODD:
        if n == size:
            break
        rank = rank[:-n] * np.uint64(odd) + rank[n:]
        n *= 2
    return mix(rank)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def segments(texts: list[bytes], size: int = THRESHOLD, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first position, number of positions, smallest rank, rank of the text) of every segment."""
    buffer, begins = joined(texts)
    if len(buffer) < size:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    rank = doubled(buffer, gram)
    low = sliding_min(rank, size - gram + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))[: len(low)]
    inside = np.arange(len(low)) + size < begins[1:][owner]  # a gap byte ends each text
    new = np.ones(len(low), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (rank[: len(low) - 1] == low[:-1]) | (inside[1:] != inside[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(low))
    real = inside[start]
    start, end = start[real], end[real]
    return owner[start], start - begins[owner[start]], end - start, low[start], span_hashes(buffer, start, end + size - 1)


def settle(a: np.ndarray, b: np.ndarray, key: np.ndarray, twin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of rows with equal (a, b) all but those at the first (key, twin, at)."""
    order = np.lexsort((at, twin, key, b, a))
    x = [v[order] for v in (a, b, key, twin, at)]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = np.zeros(len(order), dtype=bool)
    out[order] = (x[2] != x[2][first]) | (x[3] != x[3][first]) | (x[4] != x[4][first])
    return out


#: spot: place in the text, number of positions (8 bits), whether the row is settled (1 bit).
_ROWS = "a long, b long, key long, twin long, spot long"
#: A document: its id and, for rows that have one id in common, the hash of its text.
_KEY = ["key", "twin"]


def _batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    a, b, ids, at, length = (np.concatenate(x) for x in zip(*found, strict=True))
    key, twin = np.ascontiguousarray(ids[:, 0]), np.ascontiguousarray(ids[:, 1])
    settled = settle(a, b, key, twin, at)
    a = np.where(settled, mix(key.astype(np.uint64) * np.uint64(31) + at.astype(np.uint64)), a)  # anywhere
    spot = at << 9 | length << 1 | settled
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a.view(np.int64), b.view(np.int64), key, twin, spot)], names=["a", "b", *_KEY, "spot"])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _KEY], 1)


def segment_rows(slim: DataFrame, size: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = _ids(batch), []
            for first, texts in chunks(batch.column("text").to_pylist()):
                doc, at, n, low, rank = segments(texts, size, gram)
                found.append((low, rank, keys[first + doc], at, n))
            if found:
                yield _batch(found)

    return slim.mapInArrow(run, _ROWS)


def _spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """at, at + 1 ... of n positions each."""
    return np.repeat(at - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def block_rows(marked: DataFrame, size: int, gram: int) -> DataFrame:
    """Ranks of what the strings of a block share and of its text, for the segments of marked (key, twin, text, parts: array of at, len)."""
    shared = size - BLOCK + 1
    half = 1 << (min(shared, 64).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, found = _ids(batch), batch.column("parts"), []
            for first, texts in chunks(batch.column("text").to_pylist()):
                buffer, begins = joined(texts)
                if len(buffer) < size:
                    continue
                small, rank, made = doubled(buffer, gram), doubled(buffer, half), []
                for k, text in enumerate(texts):
                    at, n = (parts[first + k].values.field(c).to_numpy() for c in ("at", "len"))
                    at, n = at[at + n - 1 + size <= len(text)], n[at + n - 1 + size <= len(text)]
                    low, high = at + begins[k], at + begins[k] + n - 1
                    place = np.array([h + int(small[h : l + size - gram + 1].argmin()) for l, h in zip(low.tolist(), high.tolist(), strict=True)], dtype=np.int64)
                    least, most = (place - high) // BLOCK, (place - low) // BLOCK
                    which = _spread(least, most - least + 1)
                    own = np.repeat(np.arange(len(at)), most - least + 1)
                    core = place[own] - BLOCK * which
                    start = np.maximum(low[own], core - BLOCK + 1)
                    count = np.minimum(high[own], core) - start + 1
                    a = mix(rank[core] * np.uint64(3) + rank[core + shared - half] + which.astype(np.uint64))
                    made.append((a, start, count, np.full(len(own), k)))
                a, start, count, doc = (np.concatenate(x) for x in zip(*made, strict=True))
                whole = span_hashes(buffer, start, start + count + size - 1)
                found.append((a, whole, keys[first + doc], start - begins[doc], count))
            if found:
                yield _batch(found)

    return marked.mapInArrow(run, _ROWS)


def position_rows(marked: DataFrame, size: int) -> DataFrame:
    """Rank pairs of the positions of marked (key, twin, text, parts: array of at, len)."""
    half = 1 << (min(size, 64).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, found = _ids(batch), batch.column("parts"), []
            for first, texts in chunks(batch.column("text").to_pylist()):
                buffer, begins = joined(texts)
                if len(buffer) < size:
                    continue
                rank = doubled(buffer, half)
                for k, text in enumerate(texts):
                    s = _spread(*(parts[first + k].values.field(c).to_numpy() for c in ("at", "len")))
                    s = np.unique(s[s + size <= len(text)])
                    p = s + begins[k]
                    found.append((rank[p], rank[p + size - half], np.repeat(keys[[first + k]], len(s), axis=0), s, np.ones(len(s), dtype=np.int64)))
            if found:
                yield _batch(found)

    return marked.mapInArrow(run, _ROWS)


def _differs(other: str) -> Column:
    return (F.col(f"{other}.key") != F.col("key")) | (F.col(f"{other}.twin") != F.col("twin")) | (F.shiftright(f"{other}.spot", 9) != F.shiftright("spot", 9))


def _sorted(rows: DataFrame) -> DataFrame:
    """With the row before: repeated where a row is settled or equal to an earlier one."""
    order = Window.partitionBy("a").orderBy("b", *_KEY, "spot")
    rows = rows.withColumn("before", F.lag(F.struct("b", *_KEY, "spot")).over(order))
    same = (F.col("before.b") == F.col("b")) & _differs("before")
    return rows.withColumn("repeated", (F.col("spot") % 2 == 1) | F.coalesce(same, F.lit(False)))


def told_apart(rows: DataFrame) -> DataFrame:
    """key, twin, spot, repeated: rows with an equal (a, b) before them, and (false) the first rows of each b of an a that has several."""
    order = Window.partitionBy("a").orderBy("b", *_KEY, "spot")
    rows = _sorted(rows)
    rows = rows.withColumn("head", F.first(F.struct("b", *_KEY, "spot")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.struct(*_KEY, "spot", "repeated")
    first = F.struct(*(F.col(f"head.{c}").alias(c) for c in _KEY), F.col("head.spot").alias("spot"), F.lit(False).alias("repeated"))
    other = F.col("before.b") != F.col("b")
    out = (
        F.when(F.col("repeated"), F.array(own))
        .when(other & (F.col("before.b") == F.col("head.b")), F.array(first, own))
        .when(other, F.array(own))
    )
    return rows.select(F.explode(out).alias("x")).select("x.*")


def _by_document(rows: DataFrame) -> DataFrame:
    """key, twin, parts (array of at, len, repeated)."""
    part = F.expr("named_struct('at', shiftright(spot, 9), 'len', shiftright(spot, 1) & 255, 'repeated', repeated)")
    return rows.groupBy(*_KEY).agg(F.collect_list(part).alias("parts"))


def _those(found: DataFrame, repeated: bool) -> DataFrame:
    return found.select(*_KEY, F.filter("parts", lambda p: p["repeated"] == repeated).alias("parts")).filter(F.size("parts") > 0)


def repeats(docs: DataFrame, size: int = THRESHOLD, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """slim (key, twin, text as bytes) of every row, and marks (key, twin, parts: array of at, len): repeated strings start at at .. at + len - 1.

    The texts are shuffled by id once; the three joins with them reuse that. gram is a power of two
    below size, and two ranks of up to 64 bytes cover size.
    """
    if not BLOCK < size <= 128 or gram >= size or gram & (gram - 1):
        raise ValueError("size must be 11 to 128 and gram a smaller power of two")
    slim = docs.select(id_key().alias("key"), twin_key().alias("twin"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = cut(_by_document(told_apart(segment_rows(slim, size, gram))))
    blocks = _by_document(told_apart(block_rows(slim.join(_those(found, False), _KEY), size, gram)))
    single = _by_document(_sorted(position_rows(slim.join(_those(blocks, False), _KEY), size)).filter("repeated").select(*_KEY, "spot", "repeated"))
    marks = _those(found, True).unionByName(_those(blocks, True)).unionByName(single)
    return slim, marks.groupBy(*_KEY).agg(F.flatten(F.collect_list("parts")).alias("parts"))


def runs_of(at: np.ndarray, length: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the strings cover, in a text of n bytes."""
    order = np.argsort(at, kind="stable")
    start, end = at[order], np.minimum(at[order] + length[order] - 1 + size, n)
    start, end = start[start < end], end[start < end]
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return start[new], reach[last]


def dedup_bytes(docs: DataFrame, size: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (array of start, end), kept (bytes) of every row.

    A null text is empty; a null doc_id comes before all others. Rows with one doc_id, or with none,
    and unlike texts are documents of their own, in the order of the texts' hashes. Rows that repeat
    both doc_id and text are one document, but of those without a doc_id one is the first and the
    others are its copies.
    """
    slim, marks = repeats(docs, size, gram)
    again = (F.col("key") == F.lit(NULL_ID)) & (F.row_number().over(Window.partitionBy(*_KEY).orderBy(*_KEY)) > 1)
    joined_ = slim.join(marks, _KEY, "left").withColumn("again", again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            parts, copies = batch.column("parts"), batch.column("again").to_pylist()
            for k, text in enumerate(batch.column("text").to_pylist()):
                if copies[k] and len(text) >= size:
                    out.append((len(text), len(text), [[0, len(text)]], b""))
                    continue
                own = parts[k].values
                if own is None:
                    out.append((len(text), 0, [], text))
                    continue
                start, end = runs_of(*(own.field(c).to_numpy() for c in ("at", "len")), size, len(text))
                edges = [0, *np.stack((start, end), 1).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text), len(text) - len(kept), np.stack((start, end), 1).tolist(), kept))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True))], names=["key", "n_bytes", "n_removed", "spans", "kept"])

    found = joined_.mapInArrow(run, "key long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
    return found.select(F.nullif("key", F.lit(NULL_ID)).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept")


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, bytes]], size: int = THRESHOLD) -> dict[int, tuple[int, int, int, str]]:
    """The same for a few texts, string by string; for tests."""
    seen: set[bytes] = set()
    out = {}
    for key, text in sorted(rows):
        gone = np.zeros(len(text), dtype=bool)
        for s in range(len(text) - size + 1):
            if (x := text[s : s + size]) in seen:
                gone[s : s + size] = True
            seen.add(x)
        spans = int(np.count_nonzero(np.diff(np.concatenate(([False], gone)).astype(np.int8)) == 1))
        kept = bytes(np.frombuffer(text, dtype=np.uint8)[~gone])
        out[key] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out
