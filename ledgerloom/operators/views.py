"""Navigable views and the explorer's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import let, spans
from ledgerloom.operators import identity, mentions, observations, segmentation
from ledgerloom.operators.mentions import in_order
from ledgerloom.operators.observations import entity_order


def published_items(items: DataFrame, sections: DataFrame) -> DataFrame:
    labels = sections.select("doc_id", "section", F.col("label").alias("section_label"))
    return items.join(labels, ["doc_id", "section"]).select("doc_id", "item", "section_label", "item_type", "title", "number", "date_literal", "start_page", "end_page", "breadcrumb")


def entity_occurrences(titled: DataFrame) -> DataFrame:
    """Every entity mention with its item, if it is in one. titled: what segmentation gives, with item_title."""
    rows = observations.entities(titled, carry=("item_title",))
    return rows.select("doc_id", "entity_type", "value_normalized", "role", "item", "item_title", "page", "block_id", "start", "end", "value_original", "method")


def process_items(titled: DataFrame) -> DataFrame:
    """Process numbers and the items that mention them. titled: what segmentation gives, with item_title."""
    # a block's place in the reading order stands for its ord, which nothing here asks for
    members = titled.filter("item > 0 and doc_id is not null").withColumn("ord", F.col("n"))
    rows = mentions.mentions(members, carry=("item", "item_title"))
    return rows.select("doc_id", F.col("value_normalized").alias("process_number"), "item", "item_title", "page", "block_id", "start", "end").distinct()


def action_entities(actions: DataFrame, entities: DataFrame, items: DataFrame) -> DataFrame:
    """Actions with the persons that they name; an entity carries its action's place."""
    people = entities.filter(F.col("role") == "subject_of").select("doc_id", "block_id", F.col("action_start").alias("a_start"), "entity_type", F.col("value_normalized").alias("entity_value"), F.lit("subject").alias("participant_role"), "start", "end")
    acts = actions.select("doc_id", "item", "block_id", "page", "verb", F.col("start").alias("a_start"))
    return acts.join(people, ["doc_id", "block_id", "a_start"]).join(items.select("doc_id", "item", F.col("title").alias("item_title")), ["doc_id", "item"]).select("doc_id", "item", "item_title", "verb", "entity_type", "entity_value", "participant_role", "page", "block_id", "start", "end")


def material_entities(found: DataFrame) -> DataFrame:
    """Canonical entities with the number of fragments linked: links counted by the entity that they name."""
    entity = ["doc_id", "entity_type", "display_name"]
    rows = identity.links(found).groupBy(*entity, "reason").agg(F.count("*").alias("fragment_count"))
    basis = F.when(F.col("entity_type") == "legal_organization", "U").otherwise("S").alias("materiality_basis")
    return rows.select(*entity, basis, F.col("reason").alias("created_by_rule"), "fragment_count")


def identity_evidence(links: DataFrame) -> DataFrame:
    """Every link with its entity's name and its fragment's place."""
    return links.select("doc_id", "entity_type", "display_name", "label", "source_kind", "page", "block_id", "start", "end", "decision", "reason")


def review_queue(cases: DataFrame) -> DataFrame:
    return cases.groupBy("doc_id", "case_type", "status", "divergence", "recommended_decision", "label").agg(F.count("*").alias("fragment_count"))


# ---------------------------------------------------------------- explorer


def entity_groups(entities: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, entity_type, name, id, occurrences (array, in order), item_ids (sorted, distinct).

    An organisation also belongs to every item under its heading: breadcrumbs are exploded, so the
    containment is an equi-join. Groups are numbered by their first occurrence.
    """
    key = ["doc_id", "entity_type", F.col("value_normalized").alias("name")]
    place = F.struct(*(x.alias(f"o{i}") for i, x in enumerate(entity_order())), "block_id", "page", "start", "end", "role", "method", "item")
    own = entities.select(*key, "item", place.alias("x"))
    under = items.select("doc_id", "item", F.explode(F.array_distinct("breadcrumb")).alias("name"))
    names = entities.filter(F.col("entity_type") == "organization").select(*key).distinct()
    under = names.join(under, ["doc_id", "name"]).select("doc_id", "entity_type", "name", "item")
    rows = own.unionByName(under, allowMissingColumns=True).groupBy("doc_id", "entity_type", "name")
    rows = rows.agg(F.array_sort(F.collect_list("x")).alias("x"), F.array_sort(F.collect_set("item")).alias("item_ids"))
    occurrence = lambda x: F.struct(*(x[c].alias(c) for c in ("block_id", "page", "start", "end", "role", "method", "item")))
    rows = rows.withColumn("id", in_order([F.col("x")[0]], "entity-group", 5))
    return rows.select("doc_id", "entity_type", "name", "id", F.transform("x", occurrence).alias("occurrences"), "item_ids")


def process_groups(mentions_: DataFrame, assigned: DataFrame) -> DataFrame:
    """doc_id, value, id, occurrences (array, in order), item_ids of every process number, numbered by its first mention."""
    members = assigned.filter("item > 0").select("doc_id", "block_id", "item")
    place = F.struct("page", "ord", "start", "block_id", "end", "item", F.col("rule").alias("method")).alias("x")
    rows = mentions_.join(members, ["doc_id", "block_id"], "left").select("doc_id", F.col("value_normalized").alias("value"), "item", place)
    rows = rows.groupBy("doc_id", "value").agg(F.array_sort(F.collect_list("x")).alias("x"), F.array_sort(F.collect_set("item")).alias("item_ids"))
    occurrence = lambda x: F.struct(*(x[c].alias(c) for c in ("block_id", "page", "start", "end", "item", "method")))
    rows = rows.withColumn("id", in_order([F.col("x")[0]], "process", 5))
    return rows.select("doc_id", "value", "id", F.transform("x", occurrence).alias("occurrences"), "item_ids")


def actions_with_participant(actions: DataFrame, entities: DataFrame) -> DataFrame:
    """Every action and the first person, in the order of entities, that it names, or null."""
    first = entities.filter(F.col("role") == "subject_of").groupBy("doc_id", "block_id", F.col("action_start").alias("start")).agg(F.min_by("value_normalized", F.struct("n", "start")).alias("participant"))
    return actions.join(first, ["doc_id", "block_id", "start"], "left").select("doc_id", "item", "block_id", "verb", "start", "end", "participant")


def item_links(items: DataFrame, actions: DataFrame, references: DataFrame, provisions: DataFrame, entities: DataFrame, processes: DataFrame) -> DataFrame:
    """doc_id, item, title, actions, entities, references, processes (sorted ids), provision_count of every item.

    actions and references have an id; entities and processes are groups with id and item_ids, of
    which those of headings' containment (item_ids without an occurrence) don't count. All sides are
    stacked by kind and grouped once.
    """
    side = lambda rows, kind, id_: rows.select("doc_id", "item", F.lit(kind).alias("kind"), id_.alias("id"))
    own = lambda rows: rows.select("doc_id", "id", F.explode(F.array_distinct(F.col("occurrences")["item"])).alias("item")).filter("item is not null")
    rows = side(actions, "a", F.col("id")).unionByName(side(references, "r", F.col("id"))).unionByName(side(provisions, "p", F.lit(None).cast("string")))
    rows = rows.unionByName(side(own(entities), "e", F.col("id"))).unionByName(side(own(processes), "s", F.col("id")))
    ids = lambda kind, name: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("id")))).alias(name)
    found = rows.groupBy("doc_id", "item").agg(ids("a", "actions"), ids("e", "entities"), ids("r", "references"), ids("s", "processes"), F.count_if(F.col("kind") == "p").alias("provision_count"))
    out = items.select("doc_id", "item", "title").join(found, ["doc_id", "item"], "left")
    nothing = F.array().cast("array<string>")
    return out.withColumns({c: F.coalesce(c, nothing) for c in ("actions", "entities", "references", "processes")}).na.fill(0, ["provision_count"])


def _events(kind: str, found: Column, made: Callable[[Column], dict[str, Column]]) -> Column:
    """An array of what a block holds as array of (kind, type, name, a, b, c, d): the last four are its place among those of its kind."""

    def event(x: Column) -> Column:
        fields = {"type": F.lit(""), "name": F.lit(""), **dict.fromkeys("abcd", F.lit(0))} | made(x)
        return F.struct(F.lit(kind).alias("kind"), *(v.cast("long" if k in "abcd" else "string").alias(k) for k, v in fields.items()))

    return F.transform(found, event)


def item_links_at_once(assigned: DataFrame) -> DataFrame:
    """What item_links gives for a whole edition, from one pass over its segmentation: nothing is stored, and no text goes beyond its block.

    What a block holds is exploded where it stands and numbered by its place in the document, groups by their first place. All of it
    stays in its document's task. Rows without a document have no links, as nothing meets them.
    """
    text, n = F.col("text"), F.col("n")
    inside, known = F.col("item") > 0, F.col("doc_id").isNotNull()
    none = F.expr("cast(array() as array<struct<kind:string,type:string,name:string,a:bigint,b:bigint,c:bigint,d:bigint>>)")
    parts = [F.when(F.col("begins"), _events("t", F.array(segmentation.first_title(text, F.col("title"))), lambda x: {"name": x})).otherwise(none)]
    parts += [F.when(inside & known, _events("r", spans(text, V.PATTERNS[k]), lambda x, i=i: {"a": n, "b": F.lit(i), "c": x["start"]})).otherwise(none) for i, k in enumerate(observations.METHODS)]
    parts.append(F.when(inside & known, _events("p", spans(text, V.PATTERNS["article"]), lambda x: {})).otherwise(none))
    acts = lambda found: F.concat(_events("a", found, lambda x: {"a": n, "b": x["start"]}), _events("e", observations.named_behind(text, found), lambda x: {"type": x["entity_type"], "name": x["value_normalized"], "a": F.lit(1), "b": n, "c": x["action_start"], "d": x["start"]}))
    parts.append(F.when(inside & known, let(spans(text, V.PATTERNS["action"]), acts)).otherwise(none))
    parts.append(F.when((F.col("context") > 0) & known, _events("e", F.array(text), lambda x: {"type": F.lit("organization"), "name": x, "b": n})).otherwise(none))
    shown = known & ~F.col("noise") & (text != "")
    process = lambda x: {"name": T.normalize_process(x["value"]), "a": F.col("page"), "b": F.col("ord"), "c": x["start"], "d": n}
    parts.append(F.when(shown, _events("s", spans(text, mentions.PROCESS_RULES[0].pattern), process)).otherwise(none))
    rows = assigned.select("doc_id", F.when(inside, F.col("item")).alias("item"), F.explode(F.concat(*parts)).alias("x")).select("doc_id", "item", "x.kind", "x.type", "x.name", F.struct("x.a", "x.b", "x.c", "x.d").alias("place"))
    group = Window.partitionBy("doc_id", "kind", "type", "name")
    rows = rows.withColumn("first", F.when(F.col("kind").isin("e", "s"), F.min("place").over(group)).otherwise(F.col("place")))
    rows = rows.withColumn("number", F.dense_rank().over(Window.partitionBy("doc_id", "kind").orderBy("first")))
    ids = lambda kind, made, name: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.format_string(made, "number")))).alias(name)
    return rows.filter("item is not null").groupBy("doc_id", "item").agg(
        F.max(F.when(F.col("kind") == "t", F.col("name"))).alias("title"), ids("a", "action-%06d", "actions"), ids("e", "entity-group-%05d", "entities"),
        ids("r", "reference-%06d", "references"), ids("s", "process-%05d", "processes"), F.count_if(F.col("kind") == "p").alias("provision_count"),
    )


def search(rows: DataFrame, query: str, columns: list[str], facet: str | None = None, value: str | None = None, most: int | None = 150) -> DataFrame:
    """Rows whose columns hold the query, whatever the case and marks; the first `most` in order of all columns."""
    parts = [F.array_join(c, " ") if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in rows.dtypes if c in columns]
    found = rows.filter(F.contains(F.lower(T.without_marks(F.concat_ws(" ", *parts))), F.lower(T.without_marks(F.lit(query)))))
    if facet:
        found = found.filter(F.col(facet) == value)
    return found.orderBy(*[c for c in rows.columns]).limit(most) if most else found


def facets(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("facet")).agg(F.count("*").alias("rows"))


def evidence(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """A span's block cut in three: before, literal, after."""
    text = blocks.select("doc_id", "block_id", "text")
    cut = lambda a, n: F.substring("text", a, n)
    out = rows.join(text, ["doc_id", "block_id"])
    return out.select(*rows.columns, cut(F.lit(1), F.col("start")).alias("before"), cut(F.col("start") + 1, F.col("end") - F.col("start")).alias("literal"), cut(F.col("end") + 1, F.length("text")).alias("after"))


def related_items(titled: DataFrame, most: int = 8) -> DataFrame:
    """The first `most` items by number, with titles, of each person and position. titled: what segmentation gives, with item_title."""
    members = titled.filter("item > 0 and doc_id is not null")
    rows = observations.entities(members, carry=("item_title",)).groupBy("doc_id", "entity_type", F.col("value_normalized").alias("name"))
    first = F.slice(F.array_sort(F.collect_set(F.struct("item", F.col("item_title").alias("title")))), 1, most)
    return rows.agg(first.alias("items")).select("doc_id", "entity_type", "name", F.inline("items")).select("doc_id", "item", "entity_type", "name", "title")


def member_ordinals(items: DataFrame) -> DataFrame:
    """doc_id, item, block_id, ordinal (from 1) of every item's blocks."""
    return items.select("doc_id", "item", F.posexplode("block_ids").alias("pos", "block_id")).select("doc_id", "item", "block_id", (F.col("pos") + 1).alias("ordinal"))


def first_per_group(rows: DataFrame, by: list[str], order: list, most: int, place: str | None = None) -> DataFrame:
    """The first rows of each group, with their place if asked for; the rank prunes before the shuffle."""
    found = rows.withColumn("r_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("r_") <= most)
    return found.withColumnRenamed("r_", place) if place else found.drop("r_")
