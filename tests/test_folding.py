"""Folding and keys in any script, against the decomposition that they are defined by."""

from __future__ import annotations

import re
import unicodedata

from ledgerloom.functions import text as T

TEXTS = ["São Tomé e Príncipe", "Straße ﬁn ½ Ⅻ ㎏ ⑳", "Ἀθῆναι", "Йёлка ñandú", "𝔄𝕓𝟙", "é à̧", "한국어 データ ﾃﾞ", "ǅ ŉ ™ ª º", "", "Ａ１", "क़ुरआन"]


def test_keys_are_those_of_the_decomposition(spark):
    def key(text):
        plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        return re.sub("[^A-Z0-9]+", " ", plain.upper()).strip()

    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: r.k for r in rows.select("i", T.nominal_key(rows.text).alias("k")).collect()}
    assert got == {i: key(t) for i, t in enumerate(TEXTS)}
    assert rows.select(T.without_marks(T.F.lit(None).cast("string")).alias("x")).first().x is None


def test_marks_go_and_letters_stay(spark):
    rows = spark.createDataFrame([("Ἀθῆναι Йога ﬁn é",)], "text string")
    assert rows.select(T.without_marks(rows.text).alias("x")).first().x == "Αθηναι Иога fin e"
