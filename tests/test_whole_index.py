"""token_index over all rows and words, against brute force."""

from __future__ import annotations

import re
from collections import Counter

import __spark_entry__ as entry

TEXTS = [(1, "Der Bär ist im Haus, im Haus", "de"), (2, "a to the été", "fr"), (3, "x y x 7", None), (4, "não", "pt"), (5, None, "en")]


def test_index_of_all_rows(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter((w, i) for i, t, _ in TEXTS for w in re.findall(r"\w+", (t or "").lower().translate(str.maketrans("äéã", "aea"))))
    got = entry.queries()["token_index"](spark, str(tmp_path)).collect()
    assert {(r.token, r.doc_id): r.occurrences for r in got} == dict(want)
