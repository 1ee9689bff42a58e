"""Awkward documents that every operator must take."""

from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """n words that depend on seed alone."""
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 4096 % 97))
        if i % 11 == 10:
            out[-1] += ".\n" if i % 33 == 32 else "."
    return " ".join(out)


#: Columns that an operator could use itself.
EXTRA = "row string, key string, label string, lines string, parts string, known boolean, spot long, item string, quality_score string, bucket string, guest boolean, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id, text, lang, source and clashing columns: nulls, empty, blank, tiny, very long, repeated and near rows, ties."""
    long = prose(1, 30_000)
    near = prose(2, 200)
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "two words"), (6, long), (7, near), (8, near), (9, near.replace("alpha", "omega", 1)),
        (10, "é 🙂 naïve\x00 text ​"), (11, "\n".join([prose(3, 12)] * 5)), (12, prose(3, 12)), (None, prose(4, 60)), (None, None), (7, near), (13, prose(5, 80) + "\n" + prose(6, 60)), (14, prose(7, 30) + "\n" + prose(6, 60)),
    ]
    rows = [(i, t, "en", None, "x", "y", "z", None, "p", True, 5, "i", "q", "b", False, None) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
