"""URL filters (operator 4), in DataFrame operations only.

Two kinds of rules judge a url. Host rules (`example.net/en/`) fit a host and its subdomains when
the path begins with theirs; the longest wins. Pattern rules are regular expressions with literal
tokens that every match must contain. Each pattern rule is indexed by the one of its tokens that
is rarest among the urls; a url's tokens fetch candidate rules by an equi-join, and only those run
their expression. Both judge distinct urls, so repeated rows cost nothing, and are joined back.

Rules are DataFrames; whether they are broadcast is left to Spark, which knows their size. A token
that is common among the urls is joined only with the rules that have no rarer one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    rule: str
    verdict: str


@dataclass(frozen=True)
class PatternRule:
    """tokens: literals ([a-z0-9]+, whole tokens of the lower-cased url) in every url that the pattern matches.

    others: where the pattern's alternatives have no token in common, the tokens of each of the rest.
    Patterns mean the same to Java and RE2: `\\z` is the end, as `$` may also stand before a newline.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    others: tuple[tuple[str, ...], ...] = ()


#: What may follow a path's last word, and a parameter.
PATH_END, PARAMETER_END = r"(?:/|\?|#|\z)", r"(?:&|#|\z)"


def path_rule(word: str) -> PatternRule:
    """A word that is one step of the path; several words joined by - are one step too."""
    return PatternRule(f"path_{word}", f"/{word}{PATH_END}", tuple(word.split("-")))


def file_rule(ending: str) -> PatternRule:
    return PatternRule(f"file_{ending}", rf"\.{ending}(?:\?|#|\z)", (ending,))


def parameter_rule(name: str, value: str = "", tokens: tuple[str, ...] = ()) -> PatternRule:
    """A parameter; value is a pattern, and tokens are those that every such value has."""
    return PatternRule(f"parameter_{name}", f"[?&]{name}={value}", (*name.split("_"), *tokens))


def host_word_rule(word: str) -> PatternRule:
    """A host whose first label is the word."""
    return PatternRule(f"host_{word}", rf"://{word}\.", (word,))


HOST_RULES = (
    HostRule("net/", "block"),
    HostRule("example.net/en/", "allow"),
    HostRule("example.com/de/", "block"),
    HostRule("org/fr/", "allow"),
)

#: Accounts, shops, forms, listings, machine pages, files that hold no text, trackers.
PATHS = (
    "signup register logout account password-reset my-account cart basket checkout wishlist order-status payment donate subscribe unsubscribe newsletter "
    "contact contact-us feedback report-abuse share print email-friend search results tag tags category categories archive archives author authors feed rss atom sitemap "
    "wp-admin wp-login wp-json wp-content xmlrpc cgi-bin api graphql oauth callback redirect goto out ads adserver banner affiliate sponsored "
    "privacy privacy-policy terms terms-of-service cookies cookie-policy legal imprint disclaimer gallery slideshow calendar events-calendar polls quiz casino poker betting"
).split()
FILES = "rar gz tgz bz2 7z iso dmg exe msi apk jar deb rpm jpg jpeg png gif webp svg ico bmp tiff mp3 wav ogg flac mp4 avi mov mkv webm css js json xml woff woff2 ttf eot csv xls xlsx ppt pptx".split()
PARAMETERS = "utm_medium utm_campaign utm_term utm_content gclid fbclid msclkid replytocom share_id print_view sort_by order_by session_token captcha".split()
HOST_WORDS = "ads adserver login accounts api cdn static img mail webmail".split()

PATTERN_RULES = (
    PatternRule("tracking", rf"[?&]utm_source=feed{PARAMETER_END}", ("utm", "source", "feed")),
    PatternRule("listing", r"[?&]page=[0-9]+&ref=", ("page", "ref")),
    PatternRule("blog_page", r"://blog\.[^/?#]*/[a-z]+/[0-9]+\.html", ("blog",)),
    PatternRule("mobile", r"://m\.[^/?#]*/[^?]*\?page=[0-9]", ("m", "page")),
    PatternRule("login", rf"/(?:login|signin){PATH_END}", ("login",), (("signin",),)),
    PatternRule("signin", rf"/signin{PATH_END}", ("signin",)),
    PatternRule("archive_file", r"\.zip(?:\?|#|\z)", ("zip",)),
    PatternRule("session", r"[?&]sessionid=[0-9a-f]{8,}", ("sessionid",)),
    *map(path_rule, PATHS),
    *map(file_rule, FILES),
    *map(parameter_rule, PARAMETERS),
    *map(host_word_rule, HOST_WORDS),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(F.translate(url, UPPER, LOWER), "[^a-z0-9]+"))


def host_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule, verdict of the urls (distinct; with host and path) that a host rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rules = rules.select(
        "rule", "verdict",
        F.substring_index("rule", "/", 1).alias("rule_host"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"),
    )
    found = urls.select("url", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
    found = found.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict"))
    return found.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def indexed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each row of the pattern rules with the one of its tokens that the fewest urls have; ties go to the first in order."""
    wanted = rules.select("name", "pattern", "tokens", F.explode("tokens").alias("token"))
    held = urls.select(F.explode("tokens").alias("token")).join(wanted.select("token").distinct(), "token")
    counts = held.groupBy("token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))
    return wanted.join(counts, "token", "left").groupBy("name", "pattern", "tokens").agg(rarest.alias("r")).select("name", "pattern", "r.token")


def pattern_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, pattern_rule (the first by name) of the urls (distinct; with tokens) that a pattern matches."""
    found = urls.select("url", F.explode("tokens").alias("token")).join(indexed(urls, rules), "token")
    found = found.filter(F.expr("url rlike pattern"))
    return found.groupBy("url").agg(F.min("name").alias("pattern_rule"))


def rule_frames(spark: SparkSession, hosts=HOST_RULES, patterns=PATTERN_RULES) -> tuple[DataFrame, DataFrame]:
    a = spark.createDataFrame([(r.rule, r.verdict) for r in hosts], "rule string, verdict string")
    b = spark.createDataFrame([(r.name, r.pattern, list(t)) for r in patterns for t in (r.tokens, *r.others)], "name string, pattern string, tokens array<string>")
    return a, b


def filter_urls(pages: DataFrame, host_rules: DataFrame, pattern_rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern_rule of every row, repeated rows too.

    verdict: the host rule's; else block where a pattern matches, else allow. A null url, or one
    without `://`, has an empty host and path and is allowed unless a pattern matches it.
    """
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    urls = rows.groupBy("url").agg(F.count("*").alias("n"))
    host, path = url_parts(F.col("url"))
    urls = cut(urls.select("url", "n", host.alias("host"), path.alias("path"), url_tokens(F.col("url")).alias("tokens")))
    judged = urls.drop("tokens").join(host_verdicts(urls, host_rules), "url", "left").join(pattern_matches(urls, pattern_rules), "url", "left")
    judged = judged.withColumn("verdict", F.coalesce("verdict", F.when(F.col("pattern_rule").isNotNull(), "block").otherwise("allow")))
    return salted_join(rows, cut(judged), ["url"], ["page_id"]).select("page_id", "host", "path", "rule", "verdict", "pattern_rule")


def oracle(hosts=HOST_RULES, patterns=PATTERN_RULES) -> str:
    """The same by DuckDB, every rule against every url."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    fits, when = [], []
    for r in hosts:
        host, _, path = r.rule.partition("/")
        fits.append(
            f"case when (host = {quote(host)} or ends_with(host, {quote('.' + host)})) and starts_with(path, {quote('/' + path)}) "
            f"then {{'n': {len(r.rule)}, 'rule': {quote(r.rule)}, 'verdict': {quote(r.verdict)}}} end"
        )
    for p in sorted(patterns, key=lambda p: p.name):
        when.append(f"when regexp_matches(url, {quote(p.pattern)}) then {quote(p.name)}")
    return f"""
with a as (select page_id, coalesce(url, '') as url from pages),
b as (select *, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from a),
c as (select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from b),
d as (select *, list_max(list_filter([{", ".join(fits)}], lambda x: x is not null)) as best,
  case {" ".join(when)} end as pattern_rule from c)
select page_id, host, path, best.rule as rule,
  coalesce(best.verdict, case when pattern_rule is not null then 'block' else 'allow' end) as verdict, pattern_rule
from d"""
