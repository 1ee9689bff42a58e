"""Observations inside items: references, provisions, actions, and the persons and positions they name.

assigned: what segmentation gives. Every span is exact: substring(text, start + 1, end - start) is the literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import Rule, extract, let, spans
from ledgerloom.operators.mentions import in_order

METHODS = {"cnpj": "cnpj_checksum_v1", "monetary_value": "brl_literal_v1", "norm": "norm_literal_v1"}


def _blocks(assigned: DataFrame) -> DataFrame:
    return assigned.filter("item > 0").select("doc_id", "item", "block_id", "page", "n", "text")


def observed(assigned: DataFrame) -> DataFrame:
    """The matches of all rules in the blocks of items, in one pass; only actions carry their block's text, for the names behind them.

    Stored, it serves references, provisions, actions, entities and the counters: each takes its rows from it.
    """
    found = extract(_blocks(assigned), "text", [Rule(k, V.PATTERNS[k]) for k in (*METHODS, "article", "action")])
    return found.withColumn("text", F.when(F.col("rule") == "action", F.col("text")))


def _matches(assigned: DataFrame, found: DataFrame | None, rules: tuple[str, ...]) -> DataFrame:
    """The matches of some rules, from what observed gave or from the blocks."""
    if found is not None:
        return found.filter(F.col("rule").isin(*rules))
    return extract(_blocks(assigned), "text", [Rule(k, V.PATTERNS[k]) for k in rules])


def references(assigned: DataFrame, found: DataFrame | None = None, types: tuple[str, ...] = tuple(METHODS)) -> DataFrame:
    """doc_id, item, block_id, page, n, reference_type, start, end, value_original, value_normalized, valid, method; of some types only, if asked."""
    found = _matches(assigned, found, types)
    method = F.create_map(*[F.lit(x) for kv in METHODS.items() for x in kv])[F.col("rule")]
    return found.select(
        "doc_id", "item", "block_id", "page", "n", F.col("rule").alias("reference_type"), "start", "end", F.col("value").alias("value_original"),
        F.regexp_replace(F.upper("value"), r"(?U)\s+", " ").alias("value_normalized"),
        F.when(F.col("rule") == "cnpj", T.valid_cnpj(F.col("value"))).alias("valid"), method.alias("method"),
    )


def provisions(assigned: DataFrame, found: DataFrame | None = None) -> DataFrame:
    found = _matches(assigned, found, ("article",))
    return found.select("doc_id", "item", "block_id", "page", "n", F.col("rule").alias("kind"), F.col("value").alias("label"), "start", "end")


def _actions(assigned: DataFrame, found: DataFrame | None = None) -> DataFrame:
    found = _matches(assigned, found, ("action",))
    return found.withColumn("verb", F.regexp_replace(F.upper("value"), r"(?U)\s+", "_"))


def actions(assigned: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """doc_id, item, block_id, page, n, verb, value_original, start, end; (doc_id, block_id, start) names one."""
    return _actions(assigned, found).select("doc_id", "item", "block_id", "page", "n", "verb", F.col("value").alias("value_original"), "start", "end")


def _named(text: Column, start: Column, end: Column) -> Column:
    """Array of the person named right behind an action and of their position, which stands between the name's comma and the next; empty without a name."""

    def entity(kind: str, value: Column, normal: Column, role: str, at: Column, upto: Column, method: str) -> Column:
        fields = {"entity_type": F.lit(kind), "value_original": value, "value_normalized": normal, "role": F.lit(role), "start": at, "end": upto, "action_start": start, "method": F.lit(method)}
        return F.struct(*(c.alias(k) for k, c in fields.items()))

    def with_position(person: Column, upto: Column) -> Column:
        tail = F.substring(text, upto + 2, F.length(text))
        gap = let(F.instr(tail, ","), lambda comma: F.when(comma > 1, F.substring(text, upto + 2, comma - 1)))

        def held(gap: Column) -> Column:
            left = F.length(gap) - F.length(F.regexp_replace(gap, r"(?U)^\s+", ""))
            return let(T.strip(gap), lambda value: F.when(kept(value), placed(value, upto + 1 + left)))

        def kept(value: Column) -> Column:
            barred = ~F.length(value).between(3, 120)
            for word in V.NO_POSITION:
                barred = barred | F.lower(value).startswith(word)
            return ~barred

        def placed(value: Column, at: Column) -> Column:
            return let(at, lambda x: entity("position", value, T.normalize_spaces(value), "current_position_of", x, x + F.length(value), "position_after_person_v1"))

        return let(let(gap, held), lambda position: F.when(position.isNotNull(), F.array(person, position)).otherwise(F.array(person)))

    def with_name(rest: Column, raw: Column, name: Column) -> Column:
        barred = F.upper(name) != name
        for word in V.NO_PERSON:
            barred = barred | name.startswith(word)
        at = end + F.length(F.regexp_extract(rest, V.PERSON, 1))
        person = lambda x: entity("person", name, name, "subject_of", x, x + F.length(raw), "person_after_action_v1")
        return F.when(~barred, let(at, lambda x: let(person(x), lambda p: with_position(p, x + F.length(raw)))))

    def found(rest: Column) -> Column:
        return let(F.regexp_extract(rest, V.PERSON, 2), lambda raw: F.when(raw != "", let(T.normalize_spaces(raw), lambda name: with_name(rest, raw, name))))

    return F.coalesce(let(F.substring(text, end + 1, F.length(text)), found), F.expr(f"cast(array() as array<struct<{NAMED}>>)"))


def named_behind(text: Column, actions: Column) -> Column:
    """The persons and positions that a block names behind its actions (spans of those)."""
    return F.flatten(F.transform(actions, lambda m: _named(text, m["start"], m["end"])))


NAMED = "entity_type:string,value_original:string,value_normalized:string,role:string,start:int,end:int,action_start:int,method:string"


def entities(assigned: DataFrame, found: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, entity_type, value_original, value_normalized, role, item, block_id, page, n, start, end, action_start, method, and the columns carry of their block.

    Organisations are the blocks of contexts (item null); persons and positions follow actions,
    whose start they carry. Without stored matches the blocks are read once for all of them.
    """
    nothing = F.lit(None).cast("int")
    own = {"entity_type": F.lit("organization"), "value_original": F.col("text"), "value_normalized": F.col("text"), "role": F.lit("editorial_context"), "start": F.lit(0), "end": F.length("text"), "action_start": nothing, "method": F.lit("editorial_heading_v1")}
    heading = F.array(F.struct(*(c.alias(k) for k, c in own.items()))).cast(f"array<struct<{NAMED}>>")
    if found is None:
        named = named_behind(F.col("text"), spans(F.col("text"), V.PATTERNS["action"]))
        rows = assigned.filter("context > 0 or item > 0").withColumn("x", F.explode(F.when(F.col("context") > 0, heading).otherwise(named)))
        rows = rows.withColumn("item", F.when(F.col("item") > 0, F.col("item")))
    else:
        heads = assigned.filter("context > 0").select("doc_id", nothing.alias("item"), "block_id", "page", "n", F.explode(heading).alias("x"), *carry)
        rest = _matches(assigned, found, ("action",)).select("doc_id", "item", "block_id", "page", "n", F.explode(_named(F.col("text"), F.col("start"), F.col("end"))).alias("x"), *carry)
        rows = heads.unionByName(rest)
    return rows.select("doc_id", *(f"x.{c}" for c in ("entity_type", "value_original", "value_normalized", "role")), "item", "block_id", "page", "n", *(f"x.{c}" for c in ("start", "end", "action_start", "method")), *carry)


def numbered_actions(found: DataFrame) -> DataFrame:
    """Actions with id, in the order of the text."""
    return found.withColumn("id", in_order(["n", "start"], "action", 6))


def numbered_references(found: DataFrame) -> DataFrame:
    """References with id: block by block, and in a block kind by kind."""
    kind = F.array_position(F.array(*map(F.lit, METHODS)), F.col("reference_type"))
    return found.withColumn("id", in_order(["n", kind, "start"], "reference", 6))


def numbered_provisions(found: DataFrame) -> DataFrame:
    return found.withColumn("id", in_order(["n", "start"], "provision", 6))


def entity_order() -> list[Column]:
    """Headings first, then what actions name, each in the order of the text."""
    return [F.col("item").isNotNull(), F.col("n"), F.coalesce("action_start", F.lit(-1)), F.col("start")]


def numbered_entities(found: DataFrame) -> DataFrame:
    return found.withColumn("id", in_order(entity_order(), "entity", 6))


def entity_count(text: Column) -> Column:
    """How many persons and positions a block names."""
    return F.aggregate(spans(text, V.PATTERNS["action"]), F.lit(0), lambda n, m: n + F.size(_named(text, m["start"], m["end"])))


def semantic_counts(assigned: DataFrame) -> DataFrame:
    """doc_id and its ten counters: what each block holds is counted where it stands, then blocks are grouped by item and items by document."""
    inside, text = F.col("item") > 0, F.col("text")
    all_ = lambda rule: F.regexp_extract_all(text, F.lit(V.PATTERNS[rule]), F.lit(0))
    counted = lambda *rules: F.when(inside, sum((let(F.size(all_(rule)), lambda n: n) for rule in rules), F.lit(0))).otherwise(0)
    rows = assigned.select(
        "doc_id", "item", "page", "category", "context", (F.col("begins") & F.col("title")).alias("titled"),
        counted("action").alias("acts"), counted("article").alias("arts"), counted(*METHODS).alias("refs"), F.when(inside, entity_count(text)).otherwise(0).alias("named"),
    )
    by_item = rows.groupBy("doc_id", "item").agg(
        F.count("*").alias("n"), F.count_if(F.col("category") == "section_heading").alias("sections"), F.max("context").alias("contexts"),
        (F.min("page") != F.max("page")).alias("multi"), F.bool_or("titled").alias("titled"), F.count_if(F.col("context") > 0).alias("heads"),
        *(F.sum(c).alias(c) for c in ("acts", "arts", "refs", "named")),
    )
    real = F.col("item") > 0
    return by_item.groupBy("doc_id").agg(
        F.sum("n").alias("blocks_total"), F.sum("sections").alias("sections"), F.max("contexts").cast("long").alias("contexts"),
        F.count_if(real).alias("published_items"), F.count_if(real & F.col("multi")).alias("multi_page_items"), F.count_if(real & ~F.col("titled")).alias("unclassified_items"),
        F.sum("acts").alias("actions"), F.sum("arts").alias("provisions"), F.sum("refs").alias("references"), (F.sum("heads") + F.sum("named")).alias("entity_mentions"),
    )
