"""Byte-pair encoding, decoding and counting with published vocabularies (operators 7 and 8).

Both work on each document by itself: one pass over the table, no shuffle. What a task keeps
between texts is bounded by `Recent`.

Encoding: a vocabulary of ranks becomes a sentencepiece BPE model, written out as its protocol
buffer message: each byte is one letter of its own, each entry a piece whose score is its negative
rank, and the normaliser leaves texts alone. Pre-tokens are encoded one by one. An entry that no
chain of merges builds is still one token when it is a whole pre-token; those are looked up when
the model is built.

Counting: a heap of adjacent pairs over a linked list; the lowest rank is merged first, the
leftmost of equals. The count is the number of first symbols less the number of merges.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty

#: Pre-tokens that a task remembers at most (twice), and the longest that it remembers.
REMEMBERED, LONGEST = 100_000, 64


class Recent(dict):
    """Results by pre-token. At REMEMBERED entries the older half goes, so memory stays bounded."""

    def __init__(self, compute: Callable[[str], object]):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> object:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONGEST:
                return value
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# ---------------------------------------------------------------- a model from ranks


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes | str) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


#: Fixed values of the sentencepiece model message: field numbers and enumerators.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE, SCORE, TYPE, NORMAL, UNKNOWN = 1, 2, 3, 1, 2
MODEL_TYPE, BPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 2, 4, 40, 41, 42, 43
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5

#: Byte b is written as the letter of code point 256 + b.
LETTERS = {b: 256 + b for b in range(256)}


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def from_letters(piece: str) -> bytes:
    return bytes(ord(c) - 256 for c in piece)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model of a byte-level vocabulary; ids are ranks, and one unknown id follows."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out.append(_field(PIECES, _field(PIECE, letters(token)) + _field(SCORE, float(-rank)) + _field(TYPE, NORMAL)))
    out.append(_field(PIECES, _field(PIECE, "<unk>") + _field(SCORE, 0.0) + _field(TYPE, UNKNOWN)))
    ids = ((VOCAB_SIZE, len(ranks) + 1), (UNK_ID, len(ranks)), (BOS_ID, -1), (EOS_ID, -1), (PAD_ID, -1))
    out.append(_field(TRAINER, _field(MODEL_TYPE, BPE) + b"".join(_field(k, v) for k, v in ids)))
    off = ((DUMMY_PREFIX, 0), (EXTRA_SPACES, 0), (ESCAPE_SPACES, 0))
    out.append(_field(NORMALISER, _field(NAME, "identity") + b"".join(_field(k, v) for k, v in off)))
    return b"".join(out)


class Codec:
    def __init__(self, path: str, pattern: str):
        import sentencepiece

        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.find = regex.compile(pattern).finditer
        self.pieces = [from_letters(self.model.id_to_piece(i)) for i in range(len(ranks))]
        order = sorted(ranks, key=ranks.get)
        built = self.model.encode([letters(t) for t in order], num_threads=1)
        self.whole = {t: i for i, (t, ids) in enumerate(zip(order, built, strict=True)) if ids != [i]}
        self.known = Recent(self._pre_token)

    def pre_token(self, text: str) -> list[int]:
        data = text.encode()
        return [self.whole[data]] if data in self.whole else self.model.encode(letters(data))

    def _pre_token(self, text: str) -> tuple[int, str, bytes]:
        ids = self.pre_token(text)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        return [i for m in self.find(text) for i in self.pre_token(m[0])]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids, SHA-256 of what they decode to."""
        got = [self.known[m[0]] for m in self.find(text)]
        ids = hashlib.sha256(",".join([x[1] for x in got]).encode()).hexdigest()
        return sum([x[0] for x in got]), ids, hashlib.sha256(b"".join([x[2] for x in got])).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _each(docs: DataFrame, schema: str, function: Callable[[list[str]], list[tuple]]) -> DataFrame:
    """doc_id and what function gives for each text; a null text is empty."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            rows = function(batch.column("text").to_pylist())
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            if target is None:
                kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
                target = [kinds[c.split()[1]] for c in schema.split(", ")]
            arrays = [pa.array(c, type=t) for c, t in zip(columns, target, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return slim.mapInArrow(run, "doc_id long, " + schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) of every text; nulls are empty texts and give no ids."""
    return _each(docs, "ids array<int>", lambda texts: [(codec(path, pattern).encode(t),) for t in texts])


def encode_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: as `encode`, then decoded, without the ids."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _each(docs, schema, lambda texts: [codec(path, pattern).digest(t) for t in texts])


# ---------------------------------------------------------------- counts


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges apply to the symbols."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if symbols[i] == a else n
        if j >= n or symbols[j] != b:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = a + b, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        done += 1
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n and (r := ranks.get((symbols[left], symbols[right]))) is not None:
                heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
    return done


def byte_letters() -> dict[int, int]:
    """The usual letters of byte-level vocabularies: printable bytes stand for themselves, the others follow 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b if b in shown else 256 + hidden.index(b) for b in range(256)}


class Counter:
    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.letters = byte_letters()
        self.whole = set(spec["model"]["vocab"]) if spec["model"].get("ignore_merges") else set()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find = regex.compile(pattern).findall
        self.known = Recent(self.pre_token)

    def pre_token(self, text: str) -> int:
        symbols = text.encode().decode("latin-1").translate(self.letters)
        return 1 if symbols in self.whole else len(symbols) - merged(list(symbols), self.ranks)

    def count(self, text: str) -> int:
        pieces = self.special.split(text) if self.special else [text]
        return len(pieces) - 1 + sum([self.known[t] for p in pieces for t in self.find(p)])


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text; null texts are empty and count 0."""

    def count(texts: list[str]) -> list[tuple]:
        c = counter(path, pattern)
        found = [c.count(t) for t in texts]
        return [(len(t.encode()), n, n > limit) for t, n in zip(texts, found, strict=True)]

    return _each(docs, "n_bytes long, n_tokens long, over_limit boolean", count)
