"""nominal_keys and nominal_groups over whole texts of all rows, against brute force."""

from __future__ import annotations

import re
import unicodedata

import __spark_entry__ as entry

SAME = "Größe und Straße, " * 30
TEXTS = [
    (1, "Él dijo: mañana no. " * 10 + "fin", "es"),
    (2, SAME + "Ende", "de"),
    (3, SAME.replace(", ", " - ") + "ENDE", None),
    (4, "Él dijo: mañana no. " * 10 + "otro fin", "es"),
    (5, "kurz", "de"),
    (6, "KURZ!", "pt"),
    (7, "", "en"),
]


def key(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return re.sub("[^A-Z0-9]+", " ", plain.upper()).strip()


def test_keys_of_whole_texts(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["nominal_keys"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(i, key(t)) for i, t, _ in TEXTS]
    groups = entry.queries()["nominal_groups"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in groups} == {(key(SAME + "Ende"), 2, "2|3"), ("KURZ", 2, "5|6")}
