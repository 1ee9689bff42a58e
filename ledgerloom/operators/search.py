"""Search by index: a positional full-text index with stems, and an index of character n-grams for substrings.

Both keep postings as tables, one row per term (or gram) and row that holds it, so a search reads the postings of its
terms and never the texts. Searches are tables too: many are answered by one join. What a search asks
for is given as columns (arrays of words, a phrase, a text), not as a language of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import stemming
from ledgerloom.functions import text as T
from ledgerloom.functions.spans import let
from ledgerloom.functions.storage import checkpointed

WORD = r"(?U)[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    # by let, so that what made the text and what explodes its words aren't one generated method, which is more than the JVM compiles;
    # and with a second look at the text, so that what made it is no part of the lambda, which is interpreted
    return F.when(text.isNotNull(), let(F.lower(text), lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))))


@dataclass
class TextIndex:
    """postings: term, keys, positions (of words, from 1, sorted), occurrences, first (position), length (words of the row); and how words become terms.

    head: what a word shares with its term, if anything; headed: the postings of the terms with given heads only, if they aren't stored;
    rows: keys and length of the rows that have postings, if those aren't stored.
    """

    postings: DataFrame
    keys: list[str]
    stop: Sequence[str]
    term: Callable[[Column], Column]
    head: Callable[[Column], Column] | None = None
    headed: Callable[[list[str]], DataFrame] | None = None
    rows: DataFrame | None = None

    @property
    def lengths(self) -> DataFrame:
        """keys and length of the rows that have postings."""
        found = self.postings.select(*self.keys, "length") if self.rows is None else self.rows
        return found.distinct()

    def terms(self, queries: DataFrame, text: str) -> DataFrame:
        """query_id, offset (from 0), term of the words of a text column, without stop words."""
        rows = queries.select("query_id", F.posexplode(words(F.coalesce(F.col(text), F.lit("")))).alias("offset", "word")).filter(~F.col("word").isin(*self.stop))
        return rows.select("query_id", "offset", self.term(F.col("word")).alias("term"))


#: Up to so many terms of searches are sent to every task; more are joined by a shuffle.
SENT = 100_000


def _met(index: TextIndex, terms: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """The terms of searches, computed once; the postings of those, keys and columns; and how to join with what is as long as the terms.

    Few terms (their number is the searches', not the index's) go to the postings instead of these to them: no common term
    is sorted by one task, and an index that isn't stored makes no other postings, as the filter goes below its grouping.
    """
    terms = checkpointed(terms)
    few = terms.count() <= SENT
    sent = lambda rows: F.broadcast(rows) if few else rows
    held = index.postings
    if few and index.headed:
        held = index.headed([r.head for r in terms.select(index.head(F.col("term")).alias("head")).distinct().collect()])
    return terms, held.join(sent(terms.select("term").distinct()), "term", "left_semi").select("term", *index.keys, *columns), sent


#: The terms of so many words, the most frequent of one in SHARE of the values of the first key, are made once for all.
FREQUENT, SHARE = 20_000, 64


def text_index(rows: DataFrame, keys: Sequence[str], text: str = "text", stop: Sequence[str] = tuple(stemming.STOP_WORDS), term: Callable[[Column], Column] = stemming.stem, head: Callable[[Column], Column] | None = None) -> TextIndex:
    """The index of rows that keys name. Stop words have no postings but keep their positions; null texts and texts without words have none.

    A word's term depends on the word alone, so those of frequent words are made once and sent to every task. Which ones these are is
    told by a share of the rows; a word that isn't among them gets its term where it stands, so the postings are the same whatever the share holds.
    What a search doesn't ask for (positions, the first one) isn't collected. head: what a word and its term have in common (that of stems
    is known); words whose head no search asks for are left out of it before they get terms.
    """
    if head is None and term is stemming.stem:
        head = stemming.head
    found = rows.select(*keys, words(F.col(text)).alias("words_"))
    made = lambda word: F.coalesce(term(word), F.lit(""))

    def each(rows: DataFrame, heads: list[str] | None) -> DataFrame:
        # not a plain column: Spark infers filters on that, which are computed below it, where every row's words are then found three times
        every = F.coalesce("words_", F.expr("cast(array() as array<string>)"))
        rows = rows.select(*keys, F.size("words_").alias("length"), F.posexplode(every).alias("at", "word"))
        rows = rows.filter(~F.col("word").isin(*stop)) if stop else rows
        return rows if heads is None else rows.filter(head(F.col("word")).isin(*heads))

    def postings(heads: list[str] | None = None) -> DataFrame:
        frequent = each(found.filter(F.pmod(F.xxhash64(keys[0]), F.lit(SHARE)) == 0), heads).groupBy("word").agg(F.count("*").alias("n_"))
        frequent = frequent.orderBy(F.desc("n_"), "word").limit(FREQUENT).select("word", made(F.col("word")).alias("made_"))
        out = each(found, heads).join(F.broadcast(frequent), "word", "left").withColumn("term", F.coalesce(F.col("made_"), made(F.col("word"))))
        at = F.col("at") + 1
        out = out.groupBy("term", *keys, "length").agg(F.count("*").cast("int").alias("occurrences"), F.min(at).alias("first"), F.array_sort(F.flatten(F.collect_list(F.array(at)))).alias("positions"))
        return out.select("term", *keys, "positions", "occurrences", "first", "length")

    told = found.filter(F.exists("words_", lambda w: ~w.isin(*stop) if stop else F.lit(True)))
    return TextIndex(postings(), list(keys), list(stop), term, head, postings if head else None, told.select(*keys, F.size("words_").alias("length")))


def boolean(index: TextIndex, queries: DataFrame) -> DataFrame:
    """query_id and keys of the rows that hold all words of `all`, one of `any` (if it has words) and none of `none`.

    queries: query_id, all, any, none (arrays of words, null: empty). Words that are stop words ask for nothing; a query that asks for nothing finds nothing.
    """
    sides = F.array(*[F.struct(F.lit(role).alias("role"), F.concat_ws(" ", F.coalesce(F.col(role), F.array())).alias("text_")) for role in ("all", "any", "none")])
    sides = queries.select(F.col("query_id").alias("q_"), F.explode(sides).alias("s_")).select(F.struct("q_", "s_.role").alias("query_id"), "s_.text_")
    sides = index.terms(sides, "text_").select(F.col("query_id.q_").alias("query_id"), "query_id.role", "term").distinct()
    sides, met, sent = _met(index, sides)
    has = lambda role: F.count_if(F.col("role") == role)
    wanted = sides.groupBy("query_id").agg(has("all").alias("n_all"), has("any").alias("n_any"))
    found = met.join(sent(sides), "term").groupBy("query_id", *index.keys).agg(has("all").alias("all_"), has("any").alias("any_"), has("none").alias("none_"))
    found = found.join(sent(wanted), "query_id").filter("all_ = n_all and (n_any = 0 or any_ > 0) and none_ = 0 and n_all + n_any > 0")
    return found.select("query_id", *index.keys)


def phrases(index: TextIndex, queries: DataFrame) -> DataFrame:
    """query_id, keys, occurrences of the rows where the words of `phrase` stand behind one another; a stop word stands for any one word."""
    asked, met, sent = _met(index, index.terms(queries, "phrase"), "positions")
    size = asked.groupBy("query_id").agg(F.count("*").alias("n"))
    at = met.join(sent(asked), "term").select("query_id", *index.keys, "offset", F.explode("positions").alias("at"))
    starts = at.groupBy("query_id", *index.keys, (F.col("at") - F.col("offset")).alias("start")).agg(F.count("*").alias("met"))
    found = starts.join(sent(size), "query_id").filter("met = n")
    return found.groupBy("query_id", *index.keys).agg(F.count("*").alias("occurrences"))


def ranked(index: TextIndex, queries: DataFrame, most: int | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query_id, keys, score, rank of the rows that hold a word of `text`: BM25 over the rows that have postings; ties by keys.

    A term's rows are counted from its postings, which are stored as they are read twice; the rows and their mean length once, without terms.
    """
    rows = index.lengths.agg(F.count("*").alias("rows"), F.avg("length").alias("mean")).first()
    asked = index.terms(queries, "text").groupBy("query_id", "term").agg(F.count("*").alias("times"))
    asked, met, sent = _met(index, asked, "occurrences", "length")
    met = checkpointed(met)
    held = met.groupBy("term").agg(F.count("*").alias("holders"))
    rare = F.log1p((F.lit(rows["rows"]) - F.col("holders") + 0.5) / (F.col("holders") + 0.5))
    share = F.col("occurrences") * (k1 + 1) / (F.col("occurrences") + k1 * (1 - b + b * F.col("length") / F.lit(rows["mean"] or 1.0)))
    found = met.join(sent(asked.join(held, "term")), "term").groupBy("query_id", *index.keys).agg(F.sum(F.col("times") * rare * share).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), *index.keys)
    found = found.withColumn("rank", F.row_number().over(order))
    return found.filter(F.col("rank") <= most) if most else found


# ---------------------------------------------------------------- substrings

#: Code points of a gram, and how many of a search's rarest grams are looked up before its rows are verified.
GRAM, RAREST = 3, 4
#: Stand before and behind a text, so that one code point has grams too.
OPEN, CLOSE = "\x02", "\x03"


def folded(text: Column) -> Column:
    """Without marks and case."""
    return F.lower(T.without_marks(text))


@dataclass
class GramIndex:
    """texts: keys, folded; postings: gram, keys; holders: gram, rows."""

    texts: DataFrame
    postings: DataFrame
    holders: DataFrame
    keys: list[str]


def _grams(text: Column) -> Column:
    """The distinct grams of a text, by one pass of a pattern that looks ahead."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def gram_index(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> GramIndex:
    """The index of the columns' texts, joined by spaces as one; null counts as empty. Store postings and holders to search more than once."""
    parts = [F.array_join(c, " ") if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in rows.dtypes if c in columns]
    texts = rows.select(*keys, folded(F.concat_ws(" ", *parts)).alias("folded"))
    postings = texts.select(*keys, F.explode(_grams(F.concat(F.lit(OPEN), "folded", F.lit(CLOSE)))).alias("gram")).select("gram", *keys)
    return GramIndex(texts, postings, postings.groupBy("gram").agg(F.count("*").alias("rows")), list(keys))


def containing(index: GramIndex, queries: DataFrame, text: str = "text") -> DataFrame:
    """query_id and keys of the rows whose text holds the query's, whatever the case and marks.

    Of a query's grams the rarest few are looked up; rows in all of their postings are read and verified. A query
    shorter than a gram looks up every gram that holds it. An empty or null one finds nothing.
    Queries with one text are one until the end, and a text meets what is asked of it in the join that verifies, so no text is
    written once for each query that may be in it.
    """
    named = checkpointed(queries.select("query_id", folded(F.coalesce(F.col(text), F.lit(""))).alias("asked")).filter("asked <> ''"))
    few = named.count() <= SENT
    sent = lambda rows: F.broadcast(rows) if few else rows
    asked = named.select("asked").distinct()
    long = asked.filter(F.length("asked") >= GRAM).select("asked", F.explode(_grams(F.col("asked"))).alias("gram"))
    order = Window.partitionBy("asked").orderBy(F.coalesce("rows", F.lit(0)), "gram")
    long = long.join(index.holders, "gram", "left").withColumn("r_", F.row_number().over(order)).filter(F.col("r_") <= RAREST)
    long = long.select("asked", "gram", F.count("*").over(Window.partitionBy("asked")).alias("n"))
    # a short query's pieces of a gram: equal ones are joined, so no query is compared with every gram
    pieces = F.array_distinct(F.flatten(F.array(*[F.array(*[F.substring("gram", i, n) for i in range(1, GRAM - n + 2)]) for n in range(1, GRAM)])))
    short = asked.filter(F.length("asked") < GRAM)
    inside = index.holders.select("gram", F.explode(pieces).alias("asked")).join(sent(short), "asked").select("asked", "gram", F.lit(1).cast("long").alias("n"))
    looked = checkpointed(long.unionByName(inside))
    met = index.postings.join(F.broadcast(looked) if looked.count() <= SENT else looked, "gram")
    found = met.groupBy("asked", "n", *index.keys).agg(F.count("*").alias("met")).filter("met >= n").select("asked", *[F.col(k).alias(f"{k}_") for k in index.keys])
    same = F.contains("folded", "asked")
    for k in index.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    return found.join(index.texts, same).select("asked", *index.keys).join(sent(named), "asked").select("query_id", *index.keys)
