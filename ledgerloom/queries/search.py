"""Queries of the two search indexes, over gazette-like blocks and over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import stemming as S
from ledgerloom.functions.storage import checkpointed
from ledgerloom.operators import search
from ledgerloom.plans import gazette
from ledgerloom.plans.edition import Edition

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

WORD = r"[\pL\pN]+"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _dropped(x: str, suffixes: list[str], region: str, then: str | None = None) -> str:
    e = f"regexp_extract({x}, '{S.ending(suffixes)}')"
    return f"case when {e} <> '' and length({x}) - length({e}) >= {region} then {then or f'left({x}, length({x}) - length({e}))'} else {x} end"


def stems_sql(source: str) -> str:
    """stems (word, stem) of the distinct words of a table with column word."""
    mark = lambda p: f"coalesce(nullif(length(regexp_extract(w, '{p}')), 0), length(w))"
    short = "left(base, length(base) - 2)"
    amente = _dropped("base", ["iv", "os", "ic", "ad"], "r2", f"case when base like '%iv' then {_dropped(short, ['at'], 'r2')} else {short} end")
    return f"""
st_0 as (select distinct word, replace(replace(word, 'ã', 'a~'), 'õ', 'o~') as w from {source}),
st_1 as (select *, {mark(S.RV)} as rv, {mark(S.R1)} as r1, {mark(S.R2)} as r2, regexp_extract(w, '{S.STANDARD}') as s from st_0),
st_2 as (select *, left(w, length(w) - length(s)) as base, regexp_extract(substr(w, rv + 1), '{S.ending(S.VERB)}') as v from st_1),
st_3 as (select *, case when s = '' then null when s = 'amente' and length(base) >= r1 then {amente}
  when s in {_in(S.IRA)} and length(base) >= rv and base like '%e' then base || 'ir' when s = 'amente' or s in {_in(S.IRA)} or length(base) < r2 then null
  when s in {_in(S.GO)} then base when s in {_in(S.TO_LOG)} then base || 'log' when s in {_in(S.TO_U)} then base || 'u' when s in {_in(S.TO_ENTE)} then base || 'ente'
  when s = 'mente' then {_dropped('base', ['ante', 'avel', 'ível'], 'r2')} when s in {_in(S.ABILITY)} then {_dropped('base', ['abil', 'ic', 'iv'], 'r2')} else {_dropped('base', ['at'], 'r2')} end as std from st_2),
st_4 as (select *, coalesce(std, case when v <> '' then left(w, length(w) - length(v)) end) as cut from st_3),
st_5 as (select *, case when cut is null then {_dropped('w', S.LEFT_OVER, 'rv')} when cut like '%ci' and length(cut) - 1 >= rv then left(cut, length(cut) - 1) else cut end as x from st_4),
st_6 as (select *, left(x, length(x) - 1) as y from st_5),
stems as (select word, replace(replace(case when regexp_matches(x, '[eéê]$') and length(x) - 1 >= rv then case when regexp_matches(y, '(gu|ci)$') and length(y) - 1 >= rv then left(y, length(y) - 1) else y end
  when x like '%ç' then y || 'c' else x end, 'a~', 'ã'), 'o~', 'õ') as stem from st_6)"""


ASKED = [(1, ["portaria"], ["junho", "março"], ["brumario"]), (2, ["exonerar", "chefe"], [], []), (3, [], ["diretora", "assessores"], ["tal"]), (4, ["fulano", "processo"], [], [])]
PHRASES = [(1, "Chefe de Gabinete"), (2, "conforme a lei"), (3, "da secretaria"), (4, "autorizado o processo"), (5, "secretarias de estado")]
RANKED = [(1, "exonerar chefe de gabinete"), (2, "decreto de junho"), (3, "Secretaria da Saúde"), (4, "portarias portaria lei")]
ALL_ASKED = " ".join([w for _, *sides in ASKED for side in sides for w in side] + [t for _, t in PHRASES + RANKED])

#: Words of blocks with their places, and the postings of their stems.
WORDS = rf"""
w_a as (select doc_id, block_id, regexp_extract_all(lower(text), '{WORD}') as ws from blocks),
w_b as (select doc_id, block_id, len(ws) as length, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as spot from w_a),
w_c as (select * from w_b where word not in {_in(S.STOP_WORDS)}),
w_d as (select word from w_b union select unnest(regexp_extract_all(lower('{ALL_ASKED}'), '{WORD}'))),
{stems_sql('w_d')},
places as (select doc_id, block_id, length, spot, stem as term from w_c join stems using (word)),
postings as (select term, doc_id, block_id, length, count(*) as tf, min(spot) as first_at from places group by all)"""


def query(name: str, sql: str, *ctes: str):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(spark, Edition(gazette.blocks(spark, sf_dir)))

        QUERIES[name], ORACLE[name] = run, gazette.oracle(sql, *ctes)
        return function

    return add


def _index(e: Edition) -> search.TextIndex:
    return search.text_index(e.blocks, ["doc_id", "block_id"])


def _terms(text: str) -> str:
    """SQL: the stems of a fixed text's words, with their offsets."""
    return f"(select stem as term, o from (select unnest(ws) as word, unnest(range(len(ws))) as o from (select regexp_extract_all(lower('{text}'), '{WORD}') as ws)) join stems using (word) where word not in {_in(S.STOP_WORDS)})"


@query("text_postings", "select term, doc_id, block_id, tf as occurrences, first_at, length from postings", WORDS)
def _(spark: SparkSession, e: Edition) -> DataFrame:
    return _index(e).postings.select("term", "doc_id", "block_id", F.col("occurrences").cast("long").alias("occurrences"), F.col("first").cast("long").alias("first_at"), F.col("length").cast("long").alias("length"))


@query("portuguese_stems", "select word, stem from stems where word in (select word from w_b)", WORDS)
def _(spark: SparkSession, e: Edition) -> DataFrame:
    found = e.blocks.select(F.explode(search.words(F.col("text"))).alias("word")).distinct()
    return found.select("word", S.stem(F.col("word")).alias("stem"))


def _boolean_sql() -> str:
    holds = lambda w: f"exists (from postings p join {_terms(w)} t on p.term = t.term where p.doc_id = b.doc_id and p.block_id = b.block_id)"
    parts = []
    for number, every, some, none in ASKED:
        asked = [holds(w) for w in every] + (["(" + " or ".join(holds(w) for w in some) + ")"] if some else []) + [f"not {holds(w)}" for w in none]
        parts.append(f"select {number} as query_id, doc_id, block_id from blocks b where {' and '.join(asked)}")
    return " union all ".join(parts)


@query("text_boolean", _boolean_sql(), WORDS)
def _(spark: SparkSession, e: Edition) -> DataFrame:
    return search.boolean(_index(e), spark.createDataFrame(ASKED, "query_id int, `all` array<string>, any array<string>, none array<string>"))


@query(
    "text_phrases",
    " union all ".join(
        f"select {n} as query_id, doc_id, block_id, count(*) as occurrences from (select doc_id, block_id, spot - o as start from places p join {_terms(text)} t on p.term = t.term group by all having count(*) = (select count(*) from {_terms(text)})) group by all"
        for n, text in PHRASES
    ),
    WORDS,
)
def _(spark: SparkSession, e: Edition) -> DataFrame:
    return search.phrases(_index(e), spark.createDataFrame(PHRASES, "query_id int, phrase string"))


@query(
    "text_ranked",
    """select query_id, doc_id, block_id, rank, round(score, 6) as score from (select *, row_number() over (partition by query_id order by round(score, 9) desc, doc_id, block_id) as rank from ("""
    + " union all ".join(
        f"""select {n} as query_id, p.doc_id, p.block_id, sum(t.times * ln(1 + ((select count(*) from lengths) - d.df + 0.5) / (d.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.length / (select avg(length) from lengths)))) as score
from postings p join (select term, count(*) as times from {_terms(text)} group by 1) t on p.term = t.term join (select term, count(*) as df from postings group by 1) d on d.term = p.term group by all"""
        for n, text in RANKED
    )
    + ")) where rank <= 100",
    WORDS, "lengths as (select distinct doc_id, block_id, length from postings)",
)
def _(spark: SparkSession, e: Edition) -> DataFrame:
    found = search.ranked(_index(e), spark.createDataFrame(RANKED, "query_id int, text string"), most=100)
    return found.select("query_id", "doc_id", "block_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def item_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's second to fourth words, and its last two letters, looked for in all documents."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    index = search.gram_index(docs, ["doc_id"], ["text"])
    index.holders = checkpointed(index.holders)
    words = F.array_join(F.slice(F.split("text", " "), 2, 3), " ")
    both = F.array(F.struct(F.col("item_id").alias("q"), words.alias("t")), F.struct((-1 - F.col("item_id")).alias("q"), F.substring("text", -2, 2).alias("t")))
    queries = items.select(F.explode(both).alias("x")).select(F.col("x.q").alias("query_id"), F.col("x.t").alias("text"))
    return search.containing(index, queries)


QUERIES["item_substrings"] = item_substrings
ORACLE["item_substrings"] = """
with q as (select item_id as query_id, array_to_string(string_split(text, ' ')[2:4], ' ') as t from benchmark union all select -1 - item_id, right(text, 2) from benchmark),
d as (select doc_id, lower(strip_accents(text)) as t from documents)
select query_id, doc_id from q join d on contains(d.t, lower(strip_accents(q.t)))
"""
