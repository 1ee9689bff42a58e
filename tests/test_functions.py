"""Scalar functions and spans on hand-made cases."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import Rule, extract, spans
from pyspark.sql import functions as F


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_lines(spark):
    assert one(spark, T.normalize_line(F.col("t")), t="  GAZETA    OFICIAL\tDA CAPITAL ") == "GAZETA OFICIAL DA CAPITAL"
    assert one(spark, T.join_lines(F.col("t")), t=["Publi-", "cação Oficial", "", "guarda-", "Chuva"]) == "Publicação Oficial guarda- Chuva"
    assert one(spark, T.normalize_process(F.col("t")), t="01234- 00000099/2025- 07") == "01234-00000099/2025-07"


def test_keys(spark):
    assert one(spark, T.nominal_key(F.col("t")), t=" José d'Ávila–Conceição ") == "JOSE D AVILA CONCEICAO"
    found = one(spark, T.edition_key(F.col("t")), t="a/DODF 57 03-11-2025 Suplemento A.pdf")
    assert (found.document_key, found.edition_number, str(found.publication_date)) == ("dodf:2025-11-03:edicao-57:suplemento-a", "57", "2025-11-03")
    assert one(spark, T.edition_key(F.col("t")), t="Other.PDF").document_key == "dodf:other"
    assert one(spark, T.edition_key(F.col("t")), t="DODF 1 31-02-2025.pdf").document_key is None


@pytest.mark.parametrize("value,valid", [("33.595.865/0001-05", True), ("01.701.830/0001-32", False), ("11.111.111/1111-11", False), ("1", False), ("", False)])
def test_check_digits(spark, value, valid):
    assert one(spark, T.valid_cnpj(F.col("t")), t=value) is valid


def test_snippet(spark):
    text = "x" * 200 + " needle  here " + "y" * 200
    got = one(spark, T.snippet(F.col("t"), F.lit(201), F.lit(207), 10), t=text)
    assert got == "..." + "x" * 9 + " needle here " + "y" * 3 + "..."


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(alphabet="ab1-é🙂 ", max_size=60))
def test_spans_are_those_of_finditer(spark, text):
    got = one(spark, spans(F.col("t"), r"a+|\d-?"), t=text)
    assert [(x.start, x.end, x.value) for x in got] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"a+|\d-?", text)]


def test_rules_explode_together(spark):
    rows = spark.createDataFrame([("k", "1 a 22")], "id string, text string")
    got = extract(rows, "text", [Rule("n", r"\d+"), Rule("l", "[a-z]+", "2")]).collect()
    assert [(r.rule, r.rule_version, r.start, r.value) for r in got] == [("n", "1.0.0", 0, "1"), ("n", "1.0.0", 4, "22"), ("l", "2", 2, "a")]


def test_item_types_need_a_word_end(spark):
    rows = spark.createDataFrame([("Portaria nº 1",), ("PORTARIAS",), ("resolução x",), ("ATAS",)], "t string")
    assert [r.x for r in rows.select(F.col("t").rlike(V.ITEM_TYPE).alias("x")).collect()] == [True, False, True, False]
