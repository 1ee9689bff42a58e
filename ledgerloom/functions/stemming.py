"""Portuguese stems as expressions: the published Snowball rules, suffix by suffix, without a Python worker.

A word has regions that begin behind certain vowels and consonants; a suffix goes only if it lies in its
region. The longest suffix is the leftmost match of an alternation at the word's end. Marks stay, as
the rules need them; nasal vowels are written with a tilde of its own meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: vowels, and suffixes by what becomes of them
VOWELS = "aeiouáéíóúâêô"
GO = (
    "eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos "
    "adora ador aça~o adoras adores aço~es ante antes ância"
).split()
TO_LOG, TO_U, TO_ENTE = ["logia", "logias"], ["uça~o", "uço~es"], ["ência", "ências"]
ABILITY, IVE, IRA = ["idade", "idades"], ["iva", "ivo", "ivas", "ivos"], ["ira", "iras"]
VERB = (
    "ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam eriam iriam aram eram "
    "iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er ir as adas idas ias arias erias "
    "irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses esses isses astes estes istes is ais eis íeis "
    "aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos amos íamos aríamos eríamos "
    "iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos íssemos imos armos ermos irmos eu iu ou ira iras"
).split()
LEFT_OVER = ["os", "a", "i", "o", "á", "í", "ó"]
STOP_WORDS = (
    "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando muito nos já eu também só pelo "
    "pela até isso ela entre depois sem mesmo aos seus quem nas me esse eles você essa num nem suas meu às minha numa pelos elas qual nós lhe deles "
    "essas esses pelas este dele tu te vocês vos lhes meus minhas teu tua teus tuas nosso nossa nossos nossas dela delas esta estes estas aquele "
    "aquela aqueles aquelas isto aquilo"
).split()

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
#: What lies before a region: RV, R1 and R2.
RV = f"^(?:.{_C}{_C}*{_V}|{_V}{_V}+{_C}|{_C}{_V}.)"
R1 = f"^{_C}*{_V}+{_C}"
R2 = f"^{_C}*{_V}+{_C}+{_V}+{_C}"


def ending(suffixes: list[str]) -> str:
    return f"(?:{'|'.join(suffixes)})$"


STANDARD = ending([*GO, *TO_LOG, *TO_U, *TO_ENTE, "amente", "mente", *ABILITY, *IVE, *IRA])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _less(word: Column, suffix: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(suffix))


def _dropped(word: Column, suffixes: list[str], region: Column, then: Callable[[Column, Column], Column] | None = None) -> Column:
    """word without the longest of the suffixes, if that lies in the region; then() may take more away."""

    def cut(suffix: Column) -> Column:
        rest = _less(word, suffix)
        return F.when((suffix != "") & (F.length(rest) >= region), then(rest, suffix) if then else rest).otherwise(word)

    return let(F.regexp_extract(word, ending(suffixes), 0), cut)


def _standard(m: Column) -> Column:
    """The word after the rule of its longest standard suffix; null where that doesn't apply."""
    word, r2 = m["word"], m["r2"]

    def apply(suffix: Column) -> Column:
        base = _less(word, suffix)
        size = F.length(base)
        at = lambda rest, gone: F.when(gone == "iv", _dropped(rest, ["at"], r2)).otherwise(rest)
        return (
            F.when(suffix == "", F.lit(None).cast("string"))
            .when((suffix == "amente") & (size >= m["r1"]), _dropped(base, ["iv", "os", "ic", "ad"], r2, at))
            .when(suffix.isin(*IRA) & (size >= m["rv"]) & base.endswith("e"), F.concat(base, F.lit("ir")))
            .when(suffix.isin("amente", *IRA) | (size < r2), F.lit(None).cast("string"))
            .when(suffix.isin(*GO), base)
            .when(suffix.isin(*TO_LOG), F.concat(base, F.lit("log")))
            .when(suffix.isin(*TO_U), F.concat(base, F.lit("u")))
            .when(suffix.isin(*TO_ENTE), F.concat(base, F.lit("ente")))
            .when(suffix == "mente", _dropped(base, ["ante", "avel", "ível"], r2))
            .when(suffix.isin(*ABILITY), _dropped(base, ["abil", "ic", "iv"], r2))
            .otherwise(_dropped(base, ["at"], r2))
        )

    return let(F.regexp_extract(word, STANDARD, 0), apply)


def _verb(m: Column) -> Column:
    """The word without the longest verb suffix of its region; null where there is none."""
    region = F.substring(m["word"], m["rv"] + 1, F.length(m["word"]))
    return let(F.regexp_extract(region, ending(VERB), 0), lambda suffix: F.when(suffix != "", _less(m["word"], suffix)))


def _last(word: Column, rv: Column) -> Column:
    """Without a final e in the region (and the u or i of gu or ci before it); a final ç is a c."""
    rest = F.substring(word, F.lit(1), F.length(word) - 1)
    soft = lambda x: F.when(x.rlike("(?:gu|ci)$") & (F.length(x) - 1 >= rv), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)
    final = word.rlike("[eéê]$")
    return F.when(final & (F.length(word) - 1 >= rv), let(rest, soft)).when(word.endswith("ç"), F.concat(rest, F.lit("c"))).otherwise(word)


def _stem(m: Column) -> Column:
    rv = m["rv"]

    def settle(cut: Column) -> Column:
        no_i = F.when(cut.endswith("ci") & (F.length(cut) - 1 >= rv), F.substring(cut, F.lit(1), F.length(cut) - 1)).otherwise(cut)
        return F.when(cut.isNotNull(), no_i).otherwise(_dropped(m["word"], LEFT_OVER, rv))

    cut = let(_standard(m), lambda first: F.when(first.isNotNull(), first).otherwise(_verb(m)))
    found = let(let(cut, settle), lambda word: _last(word, rv))
    return F.replace(F.replace(found, F.lit("a~"), F.lit("ã")), F.lit("o~"), F.lit("õ"))


def stem(word: Column) -> Column:
    """The stem of a word in lower case; null of null, and the empty word of itself."""
    tilded = F.replace(F.replace(F.lower(word), F.lit("ã"), F.lit("a~")), F.lit("õ"), F.lit("o~"))

    def marked(w: Column) -> Column:
        before = lambda pattern: F.coalesce(F.nullif(F.length(F.regexp_extract(w, pattern, 0)), F.lit(0)), F.length(w))
        return let(F.struct(w.alias("word"), before(RV).alias("rv"), before(R1).alias("r1"), before(R2).alias("r2")), _stem)

    # every suffix ends with a letter, so a word that doesn't is its own stem
    return F.when(word.rlike(r"\p{L}$"), let(tilded, marked)).otherwise(F.lower(word))


def head(word: Column) -> Column:
    """What a word in lower case shares with its stem: the first two code points, nasal vowels with their tilde apart, but for a final ç, which becomes c.

    Regions begin behind two of them at least.
    """
    tilded = F.replace(F.replace(F.substring(word, 1, 2), F.lit("ã"), F.lit("a~")), F.lit("õ"), F.lit("o~"))
    return F.translate(F.substring(tilded, 1, 2), "ç", "c")
