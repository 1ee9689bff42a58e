"""Words of an index: found once in a row, and given terms that don't depend on which ones are made beforehand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import stemming
from ledgerloom.operators import search

TEXTS = [(i, t) for i, t in enumerate(["portarias de junho, portaria", "decreto; decretos nº 12", "ç aç açúcar maçãs", None, "", "de a o", "não nações 12 12"] * 5)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([*TEXTS, (None, "portaria sem chave")], "id int, text string")


def test_the_words_of_a_row_are_found_once(rows):
    made = rows.select("id", F.concat("text", F.lit(" "), F.col("id").cast("string")).alias("text"))
    plan = search.text_index(made, ["id"]).postings._jdf.queryExecution().optimizedPlan().toString()
    # once for the postings and once for the frequent words
    assert plan.count("regexp_extract_all(") == 2 and "collect_list" in plan
    plan = search.text_index(made, ["id"]).postings.select("term", "id", "occurrences", "first")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_postings_are_the_same_whichever_words_are_made_beforehand(rows, monkeypatch):
    found = []
    for share, frequent in ((1, 20_000), (1, 3), (1 << 40, 20_000)):
        monkeypatch.setattr(search, "SHARE", share)
        monkeypatch.setattr(search, "FREQUENT", frequent)
        found.append(sorted(map(str, search.text_index(rows, ["id"]).postings.collect())))
    assert found[0] == found[1] == found[2] and "positions=[1, 4], occurrences=2, first=1, length=4" in "".join(found[0])


def test_a_word_and_its_stem_have_one_head(spark):
    rng = random.Random(4)
    ends = [*stemming.GO, *stemming.VERB, *stemming.LEFT_OVER, *stemming.IRA, "amente", "mente", "idade", "iva", "logia", "uça~o", "ência", "ç", "e", "ê", "gue", "cie", ""]
    letters = "aeiouáãõçbcdglnrstuv1"
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(0, 5))) + rng.choice(ends).replace("a~", "ã").replace("o~", "õ") for _ in range(20_000)} | {"ãamente", "ç", "aç", "xãs"}
    table = spark.createDataFrame([(w,) for w in sorted(words)], "w string")
    assert table.filter(stemming.head(F.col("w")) != stemming.head(stemming.stem(F.col("w")))).count() == 0


def test_ranked_stores_the_postings_of_its_terms_only(spark, rows, monkeypatch):
    stored, real = [], search.checkpointed
    monkeypatch.setattr(search, "checkpointed", lambda df: stored.append(real(df)) or stored[-1])
    index = search.text_index(rows, ["id"])
    found = search.ranked(index, spark.createDataFrame([(1, "portarias")], "query_id int, text string")).collect()
    assert len(found) == 6 and [s.columns for s in stored] == [["query_id", "term", "times"], ["term", "id", "occurrences", "length"]]
    assert {r.term for r in stored[1].collect()} == {"port"}
    own = index.lengths
    index.rows = None
    assert sorted(map(str, own.collect())) == sorted(map(str, index.lengths.collect()))
