"""Scalar functions on text, as Columns."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import vocabulary as V


@cache
def _folds() -> tuple[dict[str, str], dict[str, str], str]:
    """Code points whose compatibility decomposition without marks is one other code point, those where it is several, and the marks themselves.

    Hangul stays composed, as its parts are letters and not marks.
    """
    one, several, marks = {}, {}, []
    for number in range(0x80, 0x30000):
        c = chr(number)
        if 0xAC00 <= number <= 0xD7A3 or 0xD800 <= number <= 0xDFFF:
            continue
        if unicodedata.combining(c):
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c:
            (one if len(plain) == 1 else several)[c] = plain
    return one, several, "".join(marks)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_line(text: Column) -> Column:
    """No-break spaces become spaces, runs of spaces and tabs one space, ends are stripped."""
    return strip(F.regexp_replace(F.translate(text, " ", " "), r"[ \t]+", " "))


def normalize_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def join_lines(lines: Column) -> Column:
    """An array of lines as one text; a hyphen at a line's end goes when the next begins in lower case."""
    kept = F.filter(F.transform(lines, lambda x: normalize_line(F.coalesce(x, F.lit("")))), lambda x: x != "")

    def add(done: Column, line: Column) -> Column:
        hyphen = done.endswith("-") & line.rlike(r"^\p{Ll}")
        cut = F.substring(done, F.lit(1), F.length(done) - 1)
        return F.when(done == "", line).when(hyphen, F.concat(cut, line)).otherwise(F.concat(done, F.lit(" "), line))

    return F.aggregate(kept, F.lit(""), add)


def normalize_process(value: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(value, r"(?U)\s*-\s*", "-"), r"(?U)\s*/\s*", "/"))


def snippet(text: Column, start: Column, end: Column, radius: int = 90) -> Column:
    """Up to `radius` code points on either side, spaces made one, and dots where something is cut."""
    low, high = F.greatest(F.lit(0), start - radius), F.least(F.length(text), end + radius)
    middle = normalize_spaces(F.substring(text, low + 1, high - low))
    return F.concat(F.when(low > 0, "...").otherwise(""), middle, F.when(high < F.length(text), "...").otherwise(""))


def without_marks(text: Column) -> Column:
    """Every code point's compatibility decomposition without its marks, in any script.

    Nearly all texts need one lookup per code point; only a text that holds a code point with
    several letters in it (a ligature, a fraction) is put together from pieces.
    """
    one, several, marks = _folds()
    plain = F.translate(text, "".join(one) + marks, "".join(one.values()))
    spread = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in several.items())), F.lit("\x02"), F.lit("\x01"))
    pieces = F.transform(F.split(plain, ""), lambda c: F.coalesce(F.try_element_at(spread, c), c))
    return F.when(F.length(F.translate(plain, "".join(several), "")) < F.length(plain), F.array_join(pieces, "")).otherwise(plain)


def nominal_key(text: Column) -> Column:
    """Upper case without marks, everything but A-Z and 0-9 one space."""
    return strip(F.regexp_replace(F.upper(without_marks(text)), "[^A-Z0-9]+", " "))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\D", "")


def check_digit(text: Column, length: int) -> Column:
    """Of the first `length` digits (12 or 13) of a text of ASCII digits: weights run down to 2 and then from 9 down to 2."""
    weights = [*range(length - 7, 1, -1), *range(9, 1, -1)]
    total = sum((_digit(text, i) * w for i, w in enumerate(weights)), F.lit(0))
    rest = F.pmod(total, F.lit(11))
    return F.when(rest < 2, 0).otherwise(11 - rest)


def _digit(text: Column, i: int) -> Column:
    return F.ascii(F.substring(text, i + 1, 1)) - 48


def valid_cnpj(value: Column) -> Column:
    """14 digits, not all the same, whose last two are check digits."""
    # a lambda's variable holds the digits, so that they are taken out of the value once
    sound = lambda t: t.rlike(r"^(?!([0-9])\1*$)[0-9]{14}$") & (_digit(t, 12) == check_digit(t, 12)) & (_digit(t, 13) == check_digit(t, 13))
    return F.coalesce(F.transform(F.array(digits(value)), sound)[0], F.lit(False))


def edition_key(filename: Column) -> Column:
    """(document_key, title, publication_date, edition_number) of a file name; an impossible date gives null, not an error."""
    stem = F.regexp_replace(F.regexp_extract(filename, r"([^/\\]*)$", 1), r"(.)\.[^.]*$", "$1")
    part = lambda k: F.regexp_extract(stem, V.EDITION_FILE, k)
    date = F.try_to_date(F.concat_ws("-", part(4), part(3), part(2)))
    suffix = F.replace(F.lower(strip(part(5))), F.lit(" "), F.lit("-"))
    key = F.concat(F.lit(V.EDITION_KEY + ":"), F.date_format(date, "yyyy-MM-dd"), F.lit(f":{V.EDITION_WORD}-"), part(1), F.when(suffix != "", F.concat(F.lit(":"), suffix)).otherwise(""))
    named = stem.rlike(V.EDITION_FILE)
    return F.struct(
        F.when(named, key).otherwise(F.concat(F.lit(V.EDITION_KEY + ":"), F.lower(stem))).alias("document_key"),
        stem.alias("title"),
        F.when(named, date).alias("publication_date"),
        F.when(named, part(1)).alias("edition_number"),
    )


def portable_uri(path: Column, root: str, sha256: Column) -> Column:
    """`repo:///` and the path below root, or `urn:sha256:` for a file elsewhere."""
    root = root.rstrip("/") + "/"
    return F.when(path.startswith(root), F.concat(F.lit("repo:///"), F.substring(path, F.lit(len(root) + 1), F.length(path)))).otherwise(F.concat(F.lit("urn:sha256:"), sha256))


def run_key(kind: str, *hashes: Column) -> Column:
    """Names a run by its inputs' bytes, so the same input gives the same run."""
    return F.concat_ws(":", F.lit(kind), *hashes)


def utc_stamp(time: Column, micros: bool = False) -> Column:
    """ISO text of a time in UTC, to the second or the microsecond; the session's zone doesn't matter."""
    utc = F.to_utc_timestamp(time, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'" if micros else "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
