"""Operators 7 and 8 against the libraries that they must agree with."""

from __future__ import annotations

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerloom.llm import bpe
from tokenizers import Tokenizer

RANKS, COUNTS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counts():
    return Tokenizer.from_file(COUNTS)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=200))
def test_any_text_encodes_and_counts_as_the_libraries_do(library, counts, text):
    codec = bpe.codec(RANKS, P.PATTERN)
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()
    assert bpe.counter(COUNTS, P.PATTERN).count(text) == len(counts.encode(text, add_special_tokens=False).ids)


def test_special_strings_inside_texts(counts):
    text = "a<|endoftext|><|endoftext|> b <|endoftext"
    assert bpe.counter(COUNTS, P.PATTERN).count(text) == len(counts.encode(text, add_special_tokens=False).ids)


def test_queries_on_awkward_rows(spark, awkward, nothing, library, counts):
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digest(awkward, RANKS, P.PATTERN).collect()}
    want = set()
    for r in awkward.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert rows == want
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in bpe.token_counts(awkward, COUNTS, P.PATTERN).collect())
    want = []
    for r in awkward.select("doc_id", "text").collect():
        n = len(counts.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id or 0, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert bpe.token_counts(nothing, COUNTS, P.PATTERN).count() == 0
    assert bpe.encode(nothing, RANKS, P.PATTERN).count() == 0
    assert sum(len(r.ids) for r in bpe.encode(awkward.filter("doc_id = 7"), RANKS, P.PATTERN).collect()) > 0


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    seen = []
    recent = bpe.Recent(lambda k: seen.append(k) or len(k))
    assert [recent[str(i % 7)] for i in range(50)] == [1] * 50
    assert len(recent) + len(recent.old) <= 8
    assert recent["x" * 100] == 100 and "x" * 100 not in recent
