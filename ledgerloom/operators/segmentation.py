"""Segmentation of a document's blocks into sections, editorial contexts and published items.

blocks: doc_id, page, ord, block_id, text, role, noise. What a block is by itself is an expression;
what depends on the blocks before it (is it a context or part of an item, which headings are open) is
made of running sums, extremes and last values, in windows that share one order: a document is
shuffled and sorted once and streams through them, however long it is. Items, contexts and their
texts are groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import let

TITLE_CUT = 180


def is_title(text: Column) -> Column:
    return text.rlike(V.ITEM_TYPE)


def is_heading(continuation: bool) -> Column:
    """Whether a block can be an editorial heading; a continuation needs no organisation's word."""
    text, role_ = F.col("text"), F.col("role")
    shape = (F.upper(text) == text) & (F.length(text) <= TITLE_CUT)
    plain = ~text.rlike(r"(?U)\d")
    if not continuation:
        plain = plain & text.rlike(V.ORGANISATION)
    barred = F.col("noise") | (text == "") | is_title(text)
    for start in V.NO_CONTEXT:
        barred = barred | text.startswith(start)
    return ~barred & shape & (role_.isin("h1", "h2") | (role_.isin("h3", "paragraph") & plain))


#: A document's order. All windows up to the labels share it, so that its blocks are sorted once.
_ORDER = ("page", "ord", "block_id")


def flags(blocks: DataFrame) -> DataFrame:
    """Every block with n (place in the document), title, start, more, header, imprint, roman, same, above, leads, section and opens.

    same: the block before is on the page; above: the level of the block before.
    """
    rows = blocks.select("doc_id", "page", "ord", "block_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("paragraph")).alias("role"), F.coalesce("noise", F.lit(False)).alias("noise"))
    order = Window.partitionBy("doc_id").orderBy(*_ORDER)
    # places first: what makes the blocks and all patterns in one generated method is more than the JVM compiles, which then interprets it
    rows = rows.select("*", F.row_number().over(order).alias("n"), F.coalesce(F.lag("page").over(order) == F.col("page"), F.lit(False)).alias("same"))
    rows = rows.select(
        "*",
        is_title(F.col("text")).alias("title"),
        is_heading(False).alias("start"),
        is_heading(True).alias("more"),
        (F.col("text") == V.PUBLICATION_HEADER).alias("header"),
        F.col("text").startswith(V.IMPRINT).alias("imprint"),
        F.when(~F.col("noise"), F.upper(F.nullif(F.regexp_extract("text", V.SECTION, 1), F.lit("")))).alias("roman"),
        F.when(F.col("role") == "h1", 1).when(F.col("role") == "h2", 2).otherwise(3).alias("depth"),
    )
    upto, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    # leads: whether the first block behind that decides is a title
    decides = ~(F.col("noise") | F.col("header") | F.col("imprint")) & (F.col("title") | ~F.col("more"))
    rows = rows.withColumn("decided", F.when(decides, F.col("title")))
    ahead = F.expr(f"lead(decided) ignore nulls over (partition by doc_id order by {', '.join(_ORDER)})")
    # sections open in order only: I, the first II after it, the first III after that
    one, two, three = (F.coalesce(F.col("roman") == name, F.lit(False)) for name in V.SECTIONS)
    rows = rows.select(
        "*",
        F.coalesce(ahead, F.lit(False)).alias("leads"),
        F.lag("depth").over(order).alias("above"),
        F.sum(one.cast("int")).over(upto).alias("ones"),
    )
    n, second = F.col("n"), F.col("second")
    rows = rows.select(
        "*",
        F.min(F.when(two & (F.col("ones") > 0), n)).over(upto).alias("second"),
        F.max(F.when(three, n)).over(upto).alias("third"),
        F.max(F.when(three, n)).over(earlier).alias("third_before"),
    )
    within = lambda third: F.coalesce(third > second, F.lit(False))
    section = F.when(within(F.col("third")), V.SECTIONS[2]).when(second.isNotNull(), V.SECTIONS[1]).when(F.col("ones") > 0, V.SECTIONS[0])
    opens = (one & (F.col("ones") == 1)) | F.coalesce(n == second, F.lit(False)) | (three & within(n) & ~within(F.col("third_before")))
    return rows.withColumn("section", section).withColumn("opens", opens).drop("decided", "ones", "second", "third", "third_before")


_KIND = "case when noise then 'noise' when opens then 'section_heading' when section is null and page = 1 then 'summary' when section is null then 'front_matter' when header then 'publication_header' when imprint then 'publication_metadata' else 'live' end"


def _states(rows: DataFrame, order: Window) -> DataFrame:
    """rows of flags with kind, and before and after: I, an item is open; C, the block was a context; N, neither.

    A block is a function of the state before it. Most have one result whatever that is: a section
    heading gives N, a heading that leads to a title C, a block that can't be a heading I. The others keep an open item;
    otherwise a block outside the text (noise, running lines) gives N, a heading that leads nowhere C,
    and a mere continuation keeps C, but after N it opens an item. So an item is open when the last block of
    one result says so, or when a continuation after N came since; or else the last block that isn't a continuation
    tells the state. Maxima and last values of what came before are all it takes, so no row waits for another's.
    """
    rows = rows.withColumn("kind", F.expr(_KIND))
    live, start, n = F.col("kind") == "live", F.col("start"), F.col("n").cast("long")
    joins = F.when(F.col("same"), F.col("more")).otherwise(start)
    code = (
        F.when(F.col("kind") == "section_heading", "N").when(~live, "outside").when(start & F.col("leads"), "C")
        .when(~joins & ~start, "I").when(start, "heading").otherwise("continues")
    )
    rows = rows.withColumn("code", code)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("code").isin("N", "C", "I"), n * 2 + (F.col("code") == "I").cast("int"))  # its place, and whether it opens an item
    rows = rows.select(
        "*",
        F.coalesce(F.max(fixed).over(earlier), F.lit(0)).alias("fixed"),
        F.coalesce(F.last(F.when(F.col("code") != "continues", F.col("code")), ignorenulls=True).over(earlier), F.lit("N")).alias("told"),
    )
    opens = (F.col("code") == "continues") & F.col("told").isin("N", "outside")
    opened = F.coalesce(F.max(F.when(opens, n * 2)).over(earlier), F.lit(0))
    rows = rows.withColumn("opened", opened)
    item = (F.col("fixed") % 2 == 1) | (F.col("opened") > F.col("fixed"))
    rows = rows.withColumn("before", F.when(item, "I").when(F.col("told").isin("C", "heading"), "C").otherwise("N"))
    kept = (F.col("before") == "I") & F.col("code").isin("outside", "heading", "continues")
    after = (
        F.when(kept, "I").when(F.col("code").isin("N", "C", "I"), F.col("code")).when(F.col("code") == "outside", "N")
        .when((F.col("code") == "heading") | (F.col("before") == "C"), "C").otherwise("I")
    )
    return rows.withColumn("after", after).drop("code", "fixed", "told", "opened")


def _labels(rows: DataFrame, order: Window) -> DataFrame:
    """rows with is_context, label (up to this block), new, whether the block begins a context, begins, items and run.

    A heading joins the label before it if it follows it on its page at its level, names no organisation
    and the label stays within bounds. Only neighbours on one page can join, so a run of them is short.
    Runs follow one another, so by run and then by the order before is still the document's order.
    """
    live, before, after = F.col("kind") == "live", F.col("before"), F.col("after")
    in_item = live & (after == "I")
    rows = rows.withColumns({"is_context": live & (after == "C"), "in_item": in_item, "begins": in_item & (F.col("title") | (before != "I"))})
    # only what can be a heading is a context, and only where one follows another is its text looked at again
    joins = F.col("is_context") & (before == "C") & F.col("same") & (F.col("above") == F.col("depth"))
    rows = rows.withColumn("joins", F.when(F.coalesce(joins, F.lit(False)), ~F.col("text").rlike(V.ORGANISATION)).otherwise(False))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"run": F.sum((~F.col("joins")).cast("int")).over(upto), "items": F.sum(F.col("begins").cast("int")).over(upto)})
    run = Window.partitionBy("doc_id", "run").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    fits = lambda label, x: (label != "") & (F.length(label) + 1 + F.length(x) <= TITLE_CUT)
    texts = F.collect_list(F.when(F.col("is_context"), F.col("text"))).over(run)
    label = F.aggregate(texts, F.lit(""), lambda label, x: F.when(fits(label, x), F.concat(label, F.lit(" "), x)).otherwise(x))
    rows = rows.withColumn("label", F.when(F.col("is_context"), label))
    return rows.withColumn("new", F.col("is_context") & (F.col("label") == F.col("text"))).drop("joins", "above", "same", "start", "more", "header", "imprint", "roman", "before", "after")


#: More than the blocks of any document.
_FAR = 1 << 40


def _breadcrumbs(rows: DataFrame, order: Window, titled: bool = False) -> DataFrame:
    """rows with context, item and breadcrumb; titled: and item_title, which the block that begins an item hands on.

    A context of level d cuts the open headings to d - 1 and is added, so their number is the least, over
    the contexts of its section up to it, of a context's level and the contexts since. A heading is
    the last label that was added at its place.
    """
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("contexts", F.sum(F.col("new").cast("int")).over(upto))
    # a later section's values are below all earlier ones', so the least so far is the section's own
    far = F.coalesce(F.array_position(F.array(*map(F.lit, V.SECTIONS)), F.col("section")), F.lit(0)) * _FAR
    rows = rows.withColumn("far", far)
    rows = rows.withColumns({
        "least": F.min(F.when(F.col("is_context"), F.col("depth") - F.col("contexts") - F.col("far"))).over(upto),
        "outset": F.coalesce(F.last(F.when(F.col("opens"), F.col("contexts")), ignorenulls=True).over(upto), F.lit(0)),
    })
    place = F.least(F.col("contexts") - F.col("outset"), F.col("contexts") + F.col("least") + F.col("far"))
    rows = rows.withColumn("place", F.when(F.col("is_context"), place))
    if titled:
        rows = rows.withColumn("head_title", F.when(F.col("begins"), let(F.col("text"), lambda head: first_title(head, F.col("title")))))
        rows = rows.withColumn("item_title", F.last("head_title", ignorenulls=True).over(upto))
    open_ = [F.last(F.when(F.col("place") == p, F.col("label")), ignorenulls=True).over(upto) for p in (1, 2, 3)]
    rows = rows.withColumn("open", F.array(*open_)).withColumn("deep", F.last("place", ignorenulls=True).over(upto))
    deep = F.when(F.col("contexts") > F.col("outset"), F.col("deep")).otherwise(F.lit(0)).cast("int")
    return rows.select(
        *[c for c in rows.columns if c in _KEPT],
        F.when(F.col("is_context"), F.col("contexts")).otherwise(F.lit(0)).cast("int").alias("context"),
        F.when(F.col("in_item"), F.col("items")).otherwise(F.lit(0)).cast("int").alias("item"),
        "begins",
        F.when(F.col("is_context") | F.col("begins"), F.slice("open", F.lit(1), deep)).alias("breadcrumb"),
        *([F.when(F.col("in_item") & F.col("doc_id").isNotNull(), F.col("item_title")).alias("item_title")] if titled else []),
    )


_KEPT = ("doc_id", "page", "ord", "block_id", "text", "role", "noise", "n", "title", "leads", "section", "kind")


def assign(blocks: DataFrame, titled: bool = False) -> DataFrame:
    """Every block once, with category, section, context, item (numbers from 1 in the document, else 0), begins and breadcrumb.

    titled: also item_title, the title of the block's item (null without one), so that what is found in a block needs no join with items.
    """
    document = Window.partitionBy("doc_id")
    order = document.orderBy(*_ORDER)
    out = _breadcrumbs(_labels(_states(flags(blocks), order), order), document.orderBy("run", *_ORDER), titled)
    category = F.when(F.col("kind") != "live", F.col("kind")).when(F.col("context") > 0, "editorial_context").otherwise("published_item")
    return out.withColumn("category", category).drop("kind")


def sections(assigned: DataFrame) -> DataFrame:
    rows = assigned.filter(F.col("category") == "section_heading")
    return rows.select("doc_id", F.col("section").alias("section"), F.concat(F.lit("SEÇÃO "), "section").alias("label"), F.col("block_id").alias("start_block_id"), F.col("page").alias("start_page"))


def contexts(assigned: DataFrame) -> DataFrame:
    """doc_id, context, section, level, label, block_ids, page, breadcrumb."""
    rows = assigned.filter("context > 0")
    members = F.array_sort(F.collect_list(F.struct("n", "block_id", "text", "page", "breadcrumb", "section", "role")))
    out = rows.groupBy("doc_id", "context").agg(members.alias("m"))
    first, last = F.try_element_at("m", F.lit(1)), F.try_element_at("m", F.lit(-1))
    level = F.when(first["role"] == "h1", 1).when(first["role"] == "h2", 2).otherwise(3)
    return out.select(
        "doc_id", "context", first["section"].alias("section"), level.alias("level"), F.array_join(F.col("m.text"), " ").alias("label"),
        F.col("m.block_id").alias("block_ids"), first["page"].alias("page"), last["breadcrumb"].alias("breadcrumb"),
    )


def item_type(text: Column) -> Column:
    found = F.regexp_extract(text, V.ITEM_TYPE, 1)
    return F.when(found == "", "unclassified").otherwise(F.replace(F.lower(found), F.lit(" "), F.lit("_")))


def item_date(text: Column) -> Column:
    """ISO date of a literal date; the month must be known, the day isn't checked."""
    month = F.upper(F.regexp_extract(text, V.ITEM_DATE, 2))
    number = F.array_position(F.array(*[F.lit(m) for m in V.MONTHS]), month)
    day = F.lpad(F.regexp_extract(text, V.ITEM_DATE, 1), 2, "0")
    return F.when(number > 0, F.concat_ws("-", F.regexp_extract(text, V.ITEM_DATE, 3), F.lpad(number.cast("string"), 2, "0"), day))


def item_title(text: Column) -> Column:
    """Up to the end of the first date, without spaces and points behind it, else the first sentence, 180 code points at most."""
    literal = F.regexp_extract(text, V.ITEM_DATE, 0)
    upto = F.substring(text, F.lit(1), F.instr(text, literal) + F.length(literal) - 1)
    return F.when(literal != "", F.regexp_replace(upto, r"[ .]+$", "")).otherwise(F.substring(F.substring_index(text, ". ", 1), 1, TITLE_CUT))


def first_title(head: Column, titled: Column) -> Column:
    """An item's title, from its first block and whether that is a title."""
    return F.when(titled, item_title(head)).otherwise(F.substring(head, 1, TITLE_CUT))


def items(assigned: DataFrame) -> DataFrame:
    """doc_id, item, section, breadcrumb, title, item_type, number, date_literal, act_date, block_ids, start_page, end_page, text."""
    rows = assigned.filter("item > 0")
    members = F.array_sort(F.collect_list(F.struct("n", "block_id", "page", "text", "section", "title", "breadcrumb")))
    out = rows.groupBy("doc_id", "item").agg(members.alias("m"))
    first, last = F.try_element_at("m", F.lit(1)), F.try_element_at("m", F.lit(-1))
    out = out.select("doc_id", "item", "m", first["text"].alias("head"), first["title"].alias("titled"), first["section"].alias("section"), first["breadcrumb"].alias("breadcrumb"), first["page"].alias("start_page"), last["page"].alias("end_page"))
    head, titled = F.col("head"), F.col("titled")
    found = lambda p, k: F.when(titled, F.nullif(F.regexp_extract(head, p, k), F.lit("")))
    return out.select(
        "doc_id", "item", "section", "breadcrumb",
        first_title(head, titled).alias("title"),
        F.when(titled, item_type(head)).otherwise("unclassified").alias("item_type"),
        found(V.ITEM_NUMBER, 1).alias("number"), found(V.ITEM_DATE, 0).alias("date_literal"),
        F.when(titled, item_date(head)).alias("act_date"),
        F.col("m.block_id").alias("block_ids"), "start_page", "end_page", F.array_join(F.col("m.text"), "\n\n").alias("text"),
    )
