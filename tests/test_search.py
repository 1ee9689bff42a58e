"""Stems word by word, and searches by index against scans."""

from __future__ import annotations

import math
import random
import re
import unicodedata

import pytest
from ledgerloom.functions import stemming
from ledgerloom.functions.spans import spans
from ledgerloom.operators import search
from pyspark.sql import functions as F

# words and stems of the published sample vocabulary
STEMS = """boa boa boainain boainain boas boas bôas bôas boassu boassu boataria boat boate boat boates boat boatos boat bob bob boba bob bobagem bobag
bobagens bobagens bobalhões bobalhõ bobear bob bobeira bobeir bobinho bobinh bobinhos bobinh bobo bob bobs bobs boca boc bocadas boc bocadinho bocadinh bocado boc
bocaiúva bocaiúv boçal boçal bocarra bocarr bocas boc bode bod bodoque bodoqu body body boeing boeing boem boem boemia boem boêmio boêmi boêmios boêmi bogotá bogot
boi boi bóia bói boiando boi quiabo quiab quicaram quic quickly quickly quieto quiet quietos quiet quilate quilat quilates quilat quilinhos quilinh quilo quil
quilombo quilomb quilométricas quilométr quilométricos quilométr quilômetro quilômetr quilômetros quilômetr quilos quil química químic químicas químic químico químic
químicos químic quimioterapia quimioterap quimioterápicos quimioteráp quimono quimon quincas quinc quinhão quinhã quinhentos quinhent quinn quinn quino quin
quinta quint quintal quintal quintana quintan quintanilha quintanilh quintão quintã quintessência quintessent quintino quintin quinto quint quintos quint
quintuplicou quintuplic quinze quinz quinzena quinzen quiosque quiosqu""".split()


def test_stems(spark):
    words, wanted = STEMS[::2], STEMS[1::2]
    rows = spark.createDataFrame(list(enumerate(words)) + [(-1, ""), (-2, None)], "i int, w string").select("i", stemming.stem(F.col("w")).alias("s"))
    got = {r.i: r.s for r in rows.collect()}
    assert {w: got[i] for i, w in enumerate(words)} == dict(zip(words, wanted, strict=True))
    assert got[-1] == "" and got[-2] is None
    more = {"felizmente": "feliz", "rapidamente": "rapid", "ativamente": "ativ", "nacionalidade": "nacional", "possibilidade": "possibil", "nomeação": "nomeaçã", "nomeações": "nomeaçõ", "resolução": "resolu", "resoluções": "resolu", "tecnologia": "tecnolog", "negativo": "negat", "secretaria": "secret", "exonerar": "exoner", "portaria": "port", "março": "marc", "fugue": "fug"}
    rows = spark.createDataFrame([(w,) for w in more], "w string").select("w", stemming.stem(F.col("w")).alias("s"))
    assert {r.w: r.s for r in rows.collect()} == more


TEXTS = ["Nomear o Secretário de Contratos", "nomeação de secretários; contrato novo, contratos novos", "Portaria nº 12: exonerar a pedido", "O secretário exonera. A contrato!", "", None, "de a o", "contrato", "secretário das contratos secretário das contratos secretário x contratos"]


@pytest.fixture(scope="module")
def indexed(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3)
    return search.text_index(rows, ["doc_id"])


def test_postings(indexed):
    got = {(r.term, r.doc_id): (r.positions, r.length) for r in indexed.postings.collect()}
    assert got["contrat", 1] == ([4, 6], 7)
    assert got["contrat", 8] == ([3, 6, 9], 9)
    assert not any(d in (4, 5, 6) for _, d in got)


def test_boolean_and_phrases(spark, indexed):
    asked = [(1, ["contratos", "secretários"], [], []), (2, ["contrato"], None, ["exoneram"]), (3, [], ["portarias", "novo"], []), (4, ["de"], [], []), (5, [], [], ["contrato"]), (6, ["contrato", "zebra"], [], [])]
    found = search.boolean(indexed, spark.createDataFrame(asked, "query_id int, `all` array<string>, `any` array<string>, none array<string>"))
    assert sorted(map(tuple, found.collect())) == [(1, 0), (1, 1), (1, 3), (1, 8), (2, 0), (2, 1), (2, 7), (2, 8), (3, 1), (3, 2)]
    found = search.phrases(indexed, spark.createDataFrame([(1, "secretário de contratos"), (2, "contratos novos"), (3, "contratos secretário"), (4, "zebra"), (5, None)], "query_id int, phrase string"))
    assert sorted(map(tuple, found.collect())) == [(1, 0, 1), (1, 8, 3), (2, 1, 2), (3, 8, 2)]


def test_ranks(spark, indexed):
    """BM25 by hand."""
    found = search.ranked(indexed, spark.createDataFrame([(1, "contrato secretário"), (2, "portaria")], "query_id int, text string"))
    got = {(r.query_id, r.doc_id): (r.score, r.rank) for r in found.collect()}
    held: dict = {}
    for r in indexed.postings.collect():
        held.setdefault(r.term, {})[r.doc_id] = (r.occurrences, r.length)
    lengths = {d: n for t in held.values() for d, (_, n) in t.items()}
    mean = sum(lengths.values()) / len(lengths)
    for q, terms in ((1, ["contrat", "secretári"]), (2, ["port"])):
        want: dict = {}
        for t in terms:
            idf = math.log(1 + (len(lengths) - len(held[t]) + 0.5) / (len(held[t]) + 0.5))
            for d, (tf, n) in held[t].items():
                want[d] = want.get(d, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))
        order = sorted(want, key=lambda d: (-round(want[d], 9), d))
        assert {d: (pytest.approx(want[d]), i + 1) for i, d in enumerate(order)} == {d: v for (k, d), v in got.items() if k == q}


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c)).lower()


def test_substrings_against_a_scan(spark):
    rng = random.Random(9)
    alphabet = "aAáÁbcç dé  \n.x"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) if i % 13 else None, rng.choice(["ab", "Çd"])) for i in range(300)]
    asked = ["a", "Á", "ab", "ÇD", "x", "zz", "abc", " d ", "", None, "b\n", "caá", "q", ".x."] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    index = search.gram_index(spark.createDataFrame(rows, "k int, t string, u string").repartition(4), ["k"], ["t", "u"])
    found = search.containing(index, spark.createDataFrame(list(enumerate(asked)), "query_id int, text string"))
    want = {(q, k) for q, a in enumerate(asked) if a for k, t, u in rows if plain(a) in plain(f"{t or ''} {u}")}
    assert {(r.query_id, r.k) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_spans_are_linear_and_as_before(spark):
    """A text with 40,000 matches; adjacent, first and last matches."""
    rows = spark.createDataFrame([(1, "1-23-4x5-6"), (2, ""), (3, None), (4, "x"), (5, "7" * 3), (6, "é9🙂8"), (7, "ab 12 " * 40_000)], "k int, t string")
    got = {r.k: [(x.start, x.end, x.value) for x in r.s] for r in rows.select("k", spans(F.col("t"), r"\d").alias("s")).collect() if r.s is not None}
    for k, t in [(1, "1-23-4x5-6"), (2, ""), (4, "x"), (5, "777"), (6, "é9🙂8"), (7, "ab 12 " * 40_000)]:
        assert got[k] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"\d", t)]
