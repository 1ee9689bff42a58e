"""Queries over the gazette-like blocks: segmentation, observations, identity, views, explorer.

The SQL side is written on its own: a recursive walk over the blocks instead of a fold, list
arithmetic for spans, and set joins for identity.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import rules
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.spans import Rule
from ledgerloom.operators import identity, layout, mentions, observations, views
from ledgerloom.plans import artifacts, gazette
from ledgerloom.plans.edition import Edition, dry_run, summary
from ledgerloom.functions.storage import placed as checkpointed
from ledgerloom.sources import formats, schemas

NOT_LETTER = r"[^\pL\pN_]"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(words)


def _spans(name: str, source: str, pattern: str) -> str:
    """name: source's rows with start, end_, value per match."""
    return f"""{name}_m as (select *, regexp_extract_all(text, '{pattern}') as m, string_split_regex(text, '{pattern}') as g from {source}),
{name}_u as (select *, unnest(range(1, len(m) + 1)) as i from {name}_m),
{name}_s as (select *, m[i] as value, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as start from {name}_u),
{name} as (select * exclude (m, g, i, start), cast(start as int) as start, cast(start + length(value) as int) as end_ from {name}_s)"""


SQL = {
    "processo_sei": r"\b\d{5}\s*-\s*\d{8}\s*/\s*\d{4}\s*-\s*\d{2}\b",
    "cnpj": r"\b\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\b",
    "monetary_value": r"R\$\s*[\d.]+,\d{2}",
    "norm": r"(?i)\b(?:DECRETO|LEI|PORTARIA|RESOLUÇÃO)\s+(?:N[º°o]?\s*)?[\d.]+(?:/\d{4})?",
    "article": r"(?i)\bArt\.?\s*\d+[º°o]?",
    "action": rf"(?i)\b(?:{V.SPACED_VERBS})\b",
}
DATE = r"(?i)\bDE\s+(\d{1,2})\s+DE\s+([A-ZÇ]+)\s+DE\s+(\d{4})"
NO_CONTEXT = " or ".join(f"starts_with(text, '{x}')" for x in V.NO_CONTEXT)
SHAPE = f"not noise and text <> '' and not title and not ({NO_CONTEXT}) and upper(text) = text and length(text) <= 180"

FLAGS = rf"""
f_a as (select *, cast(row_number() over (partition by doc_id order by page, ord, block_id) as int) as n,
  regexp_matches(text, '(?i)^({_any(V.ITEM_TYPES)})($|{NOT_LETTER})') as title,
  regexp_matches(text, '(?i)(^|{NOT_LETTER})({_any(V.ORGANISATION_WORDS)})($|{NOT_LETTER})') as organisation,
  text = '{V.PUBLICATION_HEADER}' as header, starts_with(text, '{V.IMPRINT}') as imprint,
  case when not noise then nullif(upper(regexp_extract(text, '(?i)^SEÇÃO\s+(I|II|III)$', 1)), '') end as roman from blocks),
f_b as (select *, {SHAPE} and (role in ('h1', 'h2') or (role in ('h3', 'paragraph') and not regexp_matches(text, '\d') and organisation)) as c0,
  {SHAPE} and (role in ('h1', 'h2') or (role in ('h3', 'paragraph') and not regexp_matches(text, '\d'))) as c1 from f_a),
f_c as (select *, coalesce(first_value(case when not noise and not header and not imprint and (title or not c1) then title end ignore nulls)
  over (partition by doc_id order by n rows between 1 following and unbounded following), false) as leads from f_b),
f_1 as (select doc_id, min(n) as s from f_c where roman = 'I' group by 1),
f_2 as (select f_c.doc_id, min(n) as s from f_c join f_1 on f_c.doc_id = f_1.doc_id where roman = 'II' and n > s group by 1),
f_3 as (select f_c.doc_id, min(n) as s from f_c join f_2 on f_c.doc_id = f_2.doc_id where roman = 'III' and n > s group by 1),
f_d as (select f_c.*, case when n >= f_3.s then 'III' when n >= f_2.s then 'II' when n >= f_1.s then 'I' end as section,
  coalesce(n = f_1.s or n = f_2.s or n = f_3.s, false) as opens from f_c left join f_1 using (doc_id) left join f_2 using (doc_id) left join f_3 using (doc_id)),
f as (select *, case when noise then 'noise' when opens then 'section_heading' when section is null and page = 1 then 'summary' when section is null then 'front_matter'
  when header then 'publication_header' when imprint then 'publication_metadata' else 'live' end as kind from f_d),
walk as (
  select doc_id, 0 as n, false as item_open, false as after, 0 as cpage, 0 as level, '' as label, cast([] as varchar[]) as crumb, 0 as contexts, 0 as items, 0 as context, 0 as item, false as begins from f where n = 1
  union all
  select doc_id, n,
    case when kind = 'section_heading' then false when kind <> 'live' then item_open else not heading end,
    heading,
    case when heading and not merges then page else cpage end,
    case when heading then depth else level end,
    case when merges then label || ' ' || text when heading then text else label end,
    case when kind = 'section_heading' then cast([] as varchar[]) when merges then list_append(crumb[1:len(crumb) - 1], label || ' ' || text) when heading then list_append(crumb[1:depth - 1], text) else crumb end,
    contexts + cast(heading and not merges as int), items + cast(begins_ as int),
    case when heading then contexts + cast(not merges as int) else 0 end,
    case when kind = 'live' and not heading then items + cast(begins_ as int) else 0 end, begins_
  from (select *, heading and joins and depth = level and not organisation and length(label) + 1 + length(text) <= 180 as merges,
      kind = 'live' and not heading and (title or not item_open) as begins_
    from (select *, kind = 'live' and (case when joins then c1 else c0 end) and (leads or not item_open) as heading
      from (select f.*, w.item_open, w.after, w.cpage, w.level, w.label, w.crumb, w.contexts, w.items, w.after and w.cpage = f.page as joins,
          case f.role when 'h1' then 1 when 'h2' then 2 else 3 end as depth
        from walk w join f on f.doc_id = w.doc_id and f.n = w.n + 1)))),
assigned as (select f.* exclude (kind), w.context, w.item, w.begins, case when w.context > 0 or w.begins then w.crumb end as breadcrumb,
  case when kind <> 'live' then kind when w.context > 0 then 'editorial_context' else 'published_item' end as category from f join walk w on f.doc_id = w.doc_id and f.n = w.n),
items as (select doc_id, item, min_by(section, n) as section, min_by(breadcrumb, n) as breadcrumb, min_by(text, n) as head, min_by(title, n) as titled,
  min_by(page, n) as start_page, max_by(page, n) as end_page, string_agg(text, chr(10) || chr(10) order by n) as text, string_agg(block_id, ',' order by n) as block_ids from assigned where item > 0 group by 1, 2)
"""

MONTHS = "[" + ", ".join(f"'{m}'" for m in V.MONTHS) + "]"
ITEMS = rf"""
i_a as (select *, regexp_extract(head, '{DATE}', 0) as literal, list_position({MONTHS}, upper(regexp_extract(head, '{DATE}', 2))) as month from items),
full_items as (select doc_id, item, section, breadcrumb,
  case when not titled then substr(head, 1, 180) when literal <> '' then rtrim(substr(head, 1, strpos(head, literal) + length(literal) - 1), ' .') else substr(string_split(head, '. ')[1], 1, 180) end as title,
  case when titled then replace(lower(regexp_extract(head, '(?i)^({_any(V.ITEM_TYPES)})($|{NOT_LETTER})', 1)), ' ', '_') else 'unclassified' end as item_type,
  case when titled then nullif(regexp_extract(head, '(?i)(?:^|{NOT_LETTER})N[º°o]?\s*([\pL\pN_./-]+)', 1), '') end as number,
  case when titled then nullif(literal, '') end as date_literal,
  case when titled and month > 0 then regexp_extract(head, '{DATE}', 3) || '-' || lpad(cast(month as varchar), 2, '0') || '-' || lpad(regexp_extract(head, '{DATE}', 1), 2, '0') end as act_date,
  block_ids, start_page, end_page, text from i_a)
"""

IN_ITEMS = "in_items as (select doc_id, item, block_id, page, n, text from assigned where item > 0)"


def _valid(value: str) -> str:
    d = f"regexp_replace({value}, '\\D', '', 'g')"
    return f"length({d}) = 14 and not regexp_matches({d}, '^(0+|1+|2+|3+|4+|5+|6+|7+|8+|9+)$') and cast(substr({d}, 13, 1) as int) = {gazette._check(d, 12)} and cast(substr({d}, 14, 1) as int) = {gazette._check(d, 13)}"


REFERENCES = ",\n".join(
    [
        *[_spans(f"r_{k}", "in_items", SQL[k]) for k in observations.METHODS],
        "refs as ("
        + " union all ".join(
            f"select doc_id, item, block_id, page, n, '{k}' as reference_type, start, end_, value as value_original, regexp_replace(upper(value), '\\s+', ' ', 'g') as value_normalized, {_valid('value') if k == 'cnpj' else 'cast(null as boolean)'} as valid, '{m}' as method from r_{k}"
            for k, m in observations.METHODS.items()
        )
        + ")",
    ]
)
PROVISIONS = _spans("provisions", "in_items", SQL["article"])
ACTIONS = _spans("acts_", "in_items", SQL["action"]) + ",\nacts as (select *, regexp_replace(upper(value), '\\s+', '_', 'g') as verb from acts_)"
PERSON = rf"(?i)^(\s*,?\s*(?:(?:A PEDIDO|POR MOTIVO DE APOSENTADORIA)\s*,?\s+)?)([{V.NAME_LETTERS}][{V.NAME_LETTERS}\s]{{2,118}}?),"
NO_PERSON = " or ".join(f"starts_with(upper(name), '{x}')" for x in V.NO_PERSON)
NO_POSITION = " or ".join(f"starts_with(lower(position_), '{x}')" for x in V.NO_POSITION)
ENTITIES = rf"""
p_a as (select *, substr(text, end_ + 1) as rest from acts),
p_b as (select *, regexp_extract(rest, '{PERSON}', 1) as lead_, regexp_extract(rest, '{PERSON}', 2) as raw from p_a),
p_c as (select *, trim(regexp_replace(raw, '\s+', ' ', 'g')) as name, end_ + length(lead_) as ns, end_ + length(lead_) + length(raw) as ne from p_b where raw <> ''),
p_d as (select *, substr(text, ne + 2) as tail from p_c where upper(name) = name and not ({NO_PERSON})),
p_e as (select *, case when strpos(tail, ',') > 1 then substr(tail, 1, strpos(tail, ',') - 1) end as gap from p_d),
p_f as (select *, trim(gap) as position_, ne + 1 + length(gap) - length(ltrim(gap)) as ps from p_e),
ents as (
  select doc_id, 'organization' as entity_type, text as value_original, text as value_normalized, 'editorial_context' as role, cast(null as int) as item, block_id, page, 0 as start, cast(length(text) as int) as end_, cast(null as int) as action_start, 'editorial_heading_v1' as method from assigned where context > 0
  union all select doc_id, 'person', name, name, 'subject_of', item, block_id, page, cast(ns as int), cast(ne as int), start, 'person_after_action_v1' from p_f
  union all select doc_id, 'position', position_, regexp_replace(position_, '\s+', ' ', 'g'), 'current_position_of', item, block_id, page, cast(ps as int), cast(ps + length(position_) as int), start, 'position_after_person_v1'
    from p_f where length(position_) between 3 and 120 and not ({NO_POSITION}))
"""
MENTIONS = (
    "seen as (select * from blocks where not noise and text <> '')," + _spans("ms", "seen", SQL["processo_sei"]) + r""",
mentions as (select doc_id, block_id, page, ord, 'processo_sei' as rule, start, end_, value as value_original, regexp_replace(regexp_replace(value, '\s*-\s*', '-', 'g'), '\s*/\s*', '/', 'g') as value_normalized,
  case when start > 90 then '...' else '' end || trim(regexp_replace(substr(text, greatest(0, start - 90) + 1, least(length(text), end_ + 90) - greatest(0, start - 90)), '\s+', ' ', 'g')) || case when end_ + 90 < length(text) then '...' else '' end as snippet from ms)"""
)
FRAGMENTS = r"""
frags as (select doc_id, entity_type, 'semantic_entity_mention' as source_kind, value_original as label, block_id, page, start, end_, trim(regexp_replace(upper(strip_accents(value_normalized)), '[^A-Z0-9]+', ' ', 'g')) as value, cast(null as boolean) as valid from ents
  union all select doc_id, 'process', 'evidence_mention', value_normalized, block_id, page, start, end_, value_normalized, true from mentions
  union all select doc_id, 'legal_organization', 'semantic_reference', value_original, block_id, page, start, end_, regexp_replace(value_normalized, '\D', '', 'g'), valid from refs where reference_type = 'cnpj'),
canon as (select distinct doc_id, entity_type, value, case entity_type when 'process' then value else 'CNPJ ' || value end as display_name, case entity_type when 'process' then 'S' else 'U' end as materiality_basis,
  case entity_type when 'process' then 'same_scoped_process_identifier_v1' else 'same_valid_cnpj_v1' end as created_by_rule from frags where entity_type in ('process', 'legal_organization') and valid)
"""
SEGMENTED = (FLAGS, ITEMS, IN_ITEMS)
OBSERVED = (*SEGMENTED, REFERENCES, PROVISIONS, ACTIONS, ENTITIES, MENTIONS, FRAGMENTS)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


#: Queries that read the segmentation once, so that nothing is written.
ONE_PASS = {"entity_mentions", "semantic_counts", "canonical_entities", "candidate_ids", "link_ids", "view_process_items", "first_processes", "view_entity_occurrences", "explorer_related_items", "explorer_items"}
#: Queries that read the matches of a rule, or of several, more than once.
MATCHES_AGAIN = {"emission_ids", "semantic_contract"}


def query(name: str, sql: str, *ctes: str):
    """Registers a function of an Edition; sql is the same over the common table expressions.

    What needs observations reads the segmentation several times, so it is stored first, unless it is one of those that
    read it once; so are the matches of the rules where they are read more than once.
    """

    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            edition = Edition(gazette.blocks(spark, sf_dir))
            again = (FRAGMENTS in ctes or ENTITIES in ctes) and name not in ONE_PASS
            return function(edition.stored(name in MATCHES_AGAIN) if again else edition)

        QUERIES[name], ORACLE[name] = run, gazette.oracle(sql, *ctes)
        return function

    return add


def _joined(column: str):
    return F.array_join(column, "|").alias(column)


@query("mentions_by_rule", "select rule, count(*) as total, count(distinct value_normalized) as distinct_values from mentions group by rule", MENTIONS)
def _(e: Edition) -> DataFrame:
    return mentions.counts_by_rule(e.mentions)


@query("process_mentions", "select doc_id, block_id, page, ord, rule, start, end_ as \"end\", value_original, value_normalized, snippet from mentions", MENTIONS)
def _(e: Edition) -> DataFrame:
    return e.mentions.drop("rule_version")


@query("mention_orphans", "select count(*) as orphans from mentions m anti join (select doc_id, block_id from blocks where ord % 20 <> 6) b on m.doc_id = b.doc_id and m.block_id = b.block_id", MENTIONS)
def _(e: Edition) -> DataFrame:
    return mentions.orphans(e.mentions, e.blocks.filter("ord % 20 <> 6")).agg(F.count("*").alias("orphans"))


@query("mention_ids", "select doc_id, block_id, start, 'processo_sei-' || lpad(cast(row_number() over (partition by doc_id order by page, ord, start) as varchar), 6, '0') as id from mentions", MENTIONS)
def _(e: Edition) -> DataFrame:
    return e.mentions.select("doc_id", "block_id", "start", mentions.in_order(["page", "ord", "start"], "processo_sei", 6).alias("id"))


@query("mention_block_text", "select m.doc_id, m.block_id, start, role, length(text) as length from mentions m join blocks b on m.doc_id = b.doc_id and m.block_id = b.block_id", MENTIONS)
def _(e: Edition) -> DataFrame:
    return mentions.with_block(e.mentions, e.blocks, "role", "text").select("doc_id", "block_id", "start", "role", F.length("text").cast("long").alias("length"))


@query("edition_summary", "select doc_id, count(distinct page) as pages, count(*) as blocks, count(*) filter (where noise) as noise_blocks, coalesce(any_value(m), 0) as mentions, coalesce(any_value(v), 0) as distinct_values, cast(0 as bigint) as orphans from blocks left join (select doc_id, count(*) as m, count(distinct value_normalized) as v from mentions group by 1) x using (doc_id) group by 1", MENTIONS)
def _(e: Edition) -> DataFrame:
    return summary(e.blocks)


@query("block_categories", "select doc_id, block_id, category, section, context, item, begins from assigned", FLAGS)
def _(e: Edition) -> DataFrame:
    return e.assigned.select("doc_id", "block_id", "category", "section", "context", "item", "begins")


@query("category_counts", "select category, count(*) as blocks, count(distinct doc_id) as documents from assigned group by 1", FLAGS)
def _(e: Edition) -> DataFrame:
    return e.assigned.groupBy("category").agg(F.count("*").alias("blocks"), F.countDistinct("doc_id").alias("documents"))


@query("sections", "select doc_id, section, 'SEÇÃO ' || section as label, block_id as start_block_id, page as start_page from assigned where category = 'section_heading'", FLAGS)
def _(e: Edition) -> DataFrame:
    return e.sections


@query("contexts", "select doc_id, context, min_by(section, n) as section, min_by(case role when 'h1' then 1 when 'h2' then 2 else 3 end, n) as level, string_agg(text, ' ' order by n) as label, string_agg(block_id, '|' order by n) as block_ids, min_by(page, n) as page, array_to_string(max_by(breadcrumb, n), '|') as breadcrumb from assigned where context > 0 group by 1, 2", FLAGS)
def _(e: Edition) -> DataFrame:
    return e.contexts.withColumns({"block_ids": _joined("block_ids"), "breadcrumb": _joined("breadcrumb")})


@query("published_items", "select doc_id, item, section, array_to_string(breadcrumb, '|') as breadcrumb, title, item_type, number, date_literal, act_date, replace(block_ids, ',', '|') as block_ids, start_page, end_page, text from full_items", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    return e.items.withColumns({"block_ids": _joined("block_ids"), "breadcrumb": _joined("breadcrumb")})


@query("references", 'select doc_id, item, block_id, page, n, reference_type, start, end_ as "end", value_original, value_normalized, valid, method from refs', *SEGMENTED, REFERENCES)
def _(e: Edition) -> DataFrame:
    return e.references


@query("provisions", "select doc_id, item, block_id, page, n, 'article' as kind, value as label, start, end_ as \"end\" from provisions", *SEGMENTED, PROVISIONS)
def _(e: Edition) -> DataFrame:
    return e.provisions


@query("actions", 'select doc_id, item, block_id, page, n, verb, value as value_original, start, end_ as "end" from acts', *SEGMENTED, ACTIONS)
def _(e: Edition) -> DataFrame:
    return e.actions


@query("entity_mentions", 'select doc_id, entity_type, value_original, value_normalized, role, item, block_id, page, start, end_ as "end", action_start, method from ents', *SEGMENTED, ACTIONS, ENTITIES)
def _(e: Edition) -> DataFrame:
    return e.entities.drop("n")


@query("span_round_trip", "select reference_type as kind, count(*) as spans, cast(0 as bigint) as broken from refs group by 1", *SEGMENTED, REFERENCES)
def _(e: Edition) -> DataFrame:
    cut = views.evidence(e.references, e.blocks)
    return cut.groupBy(F.col("reference_type").alias("kind")).agg(F.count("*").alias("spans"), F.count_if(F.col("literal") != F.col("value_original")).alias("broken"))


@query(
    "semantic_counts",
    """select doc_id, count(*) as blocks_total, count(*) filter (where category = 'section_heading') as sections, cast(max(context) as bigint) as contexts, coalesce(any_value(x.i), 0) as published_items, coalesce(any_value(x.m), 0) as multi_page_items,
  coalesce(any_value(x.u), 0) as unclassified_items, coalesce(any_value(a.c), 0) as actions, coalesce(any_value(en.c), 0) as entity_mentions, coalesce(any_value(p.c), 0) as provisions, coalesce(any_value(r.c), 0) as "references"
from assigned left join (select doc_id, count(*) as i, count(*) filter (where start_page <> end_page) as m, count(*) filter (where item_type = 'unclassified') as u from full_items group by 1) x using (doc_id)
left join (select doc_id, count(*) as c from acts group by 1) a using (doc_id) left join (select doc_id, count(*) as c from ents group by 1) en using (doc_id)
left join (select doc_id, count(*) as c from provisions group by 1) p using (doc_id) left join (select doc_id, count(*) as c from refs group by 1) r using (doc_id) group by doc_id""",
    *SEGMENTED, REFERENCES, PROVISIONS, ACTIONS, ENTITIES,
)
def _(e: Edition) -> DataFrame:
    return observations.semantic_counts(e.assigned)


@query("fragments", 'select doc_id, entity_type, source_kind, label, block_id, page, start, end_ as "end", value, valid from frags', *OBSERVED)
def _(e: Edition) -> DataFrame:
    return e.fragments.drop("item", "method")


@query("assertions", "select doc_id, block_id, start, entity_type, case entity_type when 'position' then 'title' else 'name' end as attribute, label, value as value_normalized, 'N' as materiality_class from frags where source_kind = 'semantic_entity_mention'", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return identity.assertions(e.fragments)


@query(
    "identifiers",
    "select doc_id, block_id, start, case entity_type when 'process' then 'processo_sei' else 'cnpj' end as identifier_type, label, value as value_normalized, case entity_type when 'process' then 'S' else 'U' end as materiality_class, case entity_type when 'process' then 'processo_administrativo_df' else 'brasil' end as scope, valid as is_valid, case entity_type when 'process' then 'scoped_nontransferable' else 'nontransferable' end as transferability from frags where source_kind <> 'semantic_entity_mention'",
    *OBSERVED,
)
def _(e: Edition) -> DataFrame:
    return identity.identifiers(e.fragments)


@query("canonical_entities", "select * from canon", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return identity.canonical(e.identified)


LINKS = "links as (select f.*, created_by_rule as reason, display_name, materiality_basis from frags f join canon c on f.doc_id = c.doc_id and f.entity_type = c.entity_type and f.value = c.value where f.valid)"


@query("identity_links", "select doc_id, entity_type, value, block_id, page, start, end_ as \"end\", label, source_kind, 'AUTO_LINK' as decision, reason, reason || '|no_observed_divergence' as rules from links", *OBSERVED, LINKS)
def _(e: Edition) -> DataFrame:
    return identity.links(e.fragments).drop("display_name").withColumn("rules", _joined("rules"))


@query("candidate_groups", "select doc_id, entity_type, value as candidate_key, count(*) as fragments, 'KEEP_SEPARATE' as decision from frags where source_kind = 'semantic_entity_mention' group by 1, 2, 3 having count(*) >= 2", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return identity.candidate_groups(e.fragments)


CASES = "cases as (select doc_id, block_id, start, label, 'invalid_identifier' as case_type, 'unresolved' as status, 'cnpj_checksum_invalid' as divergence, 'UNRESOLVED' as recommended_decision from frags where entity_type = 'legal_organization' and not valid)"


@query("resolution_cases", "select * from cases", *OBSERVED, CASES)
def _(e: Edition) -> DataFrame:
    return identity.cases(e.fragments)


@query(
    "identity_counts",
    """select f.doc_id, count(*) as fragments, count(*) filter (where source_kind = 'semantic_entity_mention') as assertions, count(*) filter (where source_kind <> 'semantic_entity_mention') as identifiers,
  count(distinct case when valid then entity_type || ':' || value end) as canonical_entities, count(*) filter (where valid) as identity_links, count(*) filter (where entity_type = 'legal_organization' and not valid) as resolution_cases,
  count(*) filter (where valid is not true) as unlinked_fragments, coalesce(any_value(g), 0) as candidate_groups
from frags f left join (select doc_id, count(*) as g from (select doc_id from frags where source_kind = 'semantic_entity_mention' group by doc_id, entity_type, value having count(*) >= 2) group by 1) x on f.doc_id = x.doc_id group by f.doc_id""",
    *OBSERVED,
)
def _(e: Edition) -> DataFrame:
    return identity.identity_counts(e.fragments)


@query("names_never_linked", "select count(*) as linked_names from links where source_kind = 'semantic_entity_mention'", *OBSERVED, LINKS)
def _(e: Edition) -> DataFrame:
    return identity.links(e.fragments).filter(F.col("source_kind") == "semantic_entity_mention").agg(F.count("*").alias("linked_names"))


@query("view_published_items", "select doc_id, item, 'SEÇÃO ' || section as section_label, item_type, title, number, date_literal, start_page, end_page, array_to_string(breadcrumb, '|') as breadcrumb from full_items", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    return views.published_items(e.items, e.sections).withColumn("breadcrumb", _joined("breadcrumb"))


@query("view_entity_occurrences", 'select e.doc_id, entity_type, value_normalized, role, e.item, title as item_title, page, block_id, start, end_ as "end", value_original, method from ents e left join full_items i on e.doc_id = i.doc_id and e.item = i.item', *OBSERVED)
def _(e: Edition) -> DataFrame:
    return views.entity_occurrences(e.titled)


PROCESS_ITEMS = "process_items as (select distinct m.doc_id, value_normalized as process_number, a.item, i.title as item_title, m.page, m.block_id, start, end_ from mentions m join assigned a on m.doc_id = a.doc_id and m.block_id = a.block_id and a.item > 0 join full_items i on a.doc_id = i.doc_id and a.item = i.item)"


@query("view_process_items", 'select doc_id, process_number, item, item_title, page, block_id, start, end_ as "end" from process_items', *OBSERVED, PROCESS_ITEMS)
def _(e: Edition) -> DataFrame:
    return e.stored_members().process_items


@query("view_action_entities", "select a.doc_id, a.item, title as item_title, verb, entity_type, value_normalized as entity_value, 'subject' as participant_role, a.page, a.block_id, e.start, e.end_ as \"end\" from acts a join ents e on a.doc_id = e.doc_id and a.block_id = e.block_id and a.start = e.action_start and e.role = 'subject_of' join full_items i on a.doc_id = i.doc_id and a.item = i.item", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return views.action_entities(e.actions, e.entities, e.items)


@query("view_material_entities", "select c.doc_id, c.entity_type, c.display_name, c.materiality_basis, c.created_by_rule, count(l.value) as fragment_count from canon c left join links l on c.doc_id = l.doc_id and c.entity_type = l.entity_type and c.value = l.value group by all", *OBSERVED, LINKS)
def _(e: Edition) -> DataFrame:
    return views.material_entities(e.fragments)


@query("view_identity_evidence", "select doc_id, entity_type, display_name, label, source_kind, page, block_id, start, end_ as \"end\", 'AUTO_LINK' as decision, reason from links", *OBSERVED, LINKS)
def _(e: Edition) -> DataFrame:
    return views.identity_evidence(identity.links(e.fragments))


@query("view_review_queue", "select doc_id, case_type, status, divergence, recommended_decision, label, count(*) as fragment_count from cases group by all", *OBSERVED, CASES)
def _(e: Edition) -> DataFrame:
    return views.review_queue(identity.cases(e.fragments))


GROUPS = """
eg_o as (select *, row_number() over (partition by doc_id order by item is not null, block_id, coalesce(action_start, -1), start) as seq from ents),
eg_g as (select doc_id, entity_type, value_normalized as name, min(seq) as seq,
  string_agg(block_id || ':' || page || ':' || start || ':' || end_ || ':' || role || ':' || method || ':' || coalesce(cast(item as varchar), '-'), '|' order by seq) as occurrences from eg_o group by 1, 2, 3),
groups as (select *, 'entity-group-' || lpad(cast(row_number() over (partition by doc_id order by seq) as varchar), 5, '0') as id from eg_g)"""
PROCESSES = """
pg_m as (select m.*, a.item as in_item, row_number() over (partition by m.doc_id order by m.page, m.ord, m.start) as seq from mentions m left join assigned a on m.doc_id = a.doc_id and m.block_id = a.block_id),
pg_g as (select doc_id, value_normalized as value, min(seq) as seq, string_agg(block_id || ':' || page || ':' || start || ':' || end_ || ':' || case when in_item > 0 then cast(in_item as varchar) else '-' end || ':' || rule, '|' order by seq) as occurrences,
  coalesce(array_to_string(list_sort(list_distinct(list(in_item) filter (where in_item > 0))), '|'), '') as item_ids from pg_m group by 1, 2),
processes as (select *, 'process-' || lpad(cast(row_number() over (partition by doc_id order by seq) as varchar), 5, '0') as id from pg_g)"""
NUMBERED = """
n_acts as (select *, 'action-' || lpad(cast(row_number() over (partition by doc_id order by n, start) as varchar), 6, '0') as id from acts),
n_refs as (select *, 'reference-' || lpad(cast(row_number() over (partition by doc_id order by n, case reference_type when 'cnpj' then 1 when 'monetary_value' then 2 else 3 end, start) as varchar), 6, '0') as id from refs),
n_prov as (select *, 'provision-' || lpad(cast(row_number() over (partition by doc_id order by n, start) as varchar), 6, '0') as id from provisions),
n_ents as (select *, 'entity-' || lpad(cast(row_number() over (partition by doc_id order by item is not null, block_id, coalesce(action_start, -1), start) as varchar), 6, '0') as id from ents)"""


def _flat(*fields: str):
    """Occurrences as text: their fields parted by colons, one behind the other."""
    part = lambda x: F.concat_ws(":", *(F.coalesce(x[c].cast("string"), F.lit("-")) for c in fields))
    return F.array_join(F.transform("occurrences", part), "|")


@query(
    "explorer_entities",
    """select g.doc_id, g.entity_type, g.name, g.id, g.occurrences, coalesce(x.item_ids, '') as item_ids from groups g left join (select doc_id, entity_type, name, array_to_string(list_sort(list_distinct(list(item) filter (where item is not null))), '|') as item_ids from (
  select doc_id, entity_type, value_normalized as name, item from ents
  union all select distinct e.doc_id, e.entity_type, e.value_normalized, i.item from ents e join full_items i on e.doc_id = i.doc_id and list_contains(i.breadcrumb, e.value_normalized) where e.entity_type = 'organization') group by 1, 2, 3) x
on g.doc_id = x.doc_id and g.entity_type = x.entity_type and g.name = x.name""",
    *OBSERVED, GROUPS,
)
def _(e: Edition) -> DataFrame:
    rows = views.entity_groups(e.entities, e.items)
    return rows.withColumns({"occurrences": _flat("block_id", "page", "start", "end", "role", "method", "item"), "item_ids": _joined("item_ids")})


@query("explorer_processes", "select doc_id, value, id, occurrences, item_ids from processes", *OBSERVED, PROCESSES)
def _(e: Edition) -> DataFrame:
    rows = views.process_groups(e.mentions, e.assigned)
    return rows.withColumns({"occurrences": _flat("block_id", "page", "start", "end", "item", "method"), "item_ids": _joined("item_ids")})


@query("explorer_actions", "select a.doc_id, a.item, a.block_id, verb, a.start, a.end_ as \"end\", min(e.value_normalized) as participant from acts a left join ents e on a.doc_id = e.doc_id and a.block_id = e.block_id and a.start = e.action_start and e.role = 'subject_of' group by all", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return views.actions_with_participant(e.actions, e.entities)


@query(
    "explorer_items",
    """select i.doc_id, i.item, i.title, coalesce(a.ids, '') as actions, coalesce(en.ids, '') as entities, coalesce(r.ids, '') as "references", coalesce(pr.ids, '') as processes, coalesce(p.c, 0) as provision_count from full_items i
left join (select doc_id, item, string_agg(id, '|' order by id) as ids from n_acts group by 1, 2) a using (doc_id, item)
left join (select doc_id, item, string_agg(id, '|' order by id) as ids from (select distinct e.doc_id, e.item, g.id from ents e join groups g on e.doc_id = g.doc_id and e.entity_type = g.entity_type and e.value_normalized = g.name) group by 1, 2) en using (doc_id, item)
left join (select doc_id, item, string_agg(id, '|' order by id) as ids from n_refs group by 1, 2) r using (doc_id, item)
left join (select doc_id, item, string_agg(id, '|' order by id) as ids from (select distinct m.doc_id, m.in_item as item, g.id from pg_m m join processes g on m.doc_id = g.doc_id and m.value_normalized = g.value) group by 1, 2) pr using (doc_id, item)
left join (select doc_id, item, count(*) as c from provisions group by 1, 2) p using (doc_id, item)""",
    *OBSERVED, GROUPS, PROCESSES, NUMBERED,
)
def _(e: Edition) -> DataFrame:
    return views.item_links_at_once(e.assigned).withColumns({c: _joined(c) for c in ("actions", "entities", "references", "processes")})


@query(
    "emission_ids",
    """select doc_id, id, block_id, start from n_acts union all select doc_id, id, block_id, start from n_refs union all select doc_id, id, block_id, start from n_prov union all select doc_id, id, block_id, start from n_ents""",
    *OBSERVED, NUMBERED,
)
def _(e: Edition) -> DataFrame:
    made = [observations.numbered_actions(e.actions), observations.numbered_references(e.references), observations.numbered_provisions(e.provisions), observations.numbered_entities(e.entities)]
    rows = [x.select("doc_id", "id", "block_id", "start") for x in made]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("item_ids", "select doc_id, 'item-' || lpad(cast(item as varchar), 5, '0') as id, title from full_items", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    return e.items.select("doc_id", F.format_string("item-%05d", "item").alias("id"), "title")


@query(
    "canonical_ids",
    "select doc_id, 'canonical-' || lpad(cast(row_number() over (partition by doc_id order by case entity_type when 'process' then 0 else 1 end, value) as varchar), 6, '0') as id, display_name from canon",
    *OBSERVED,
)
def _(e: Edition) -> DataFrame:
    return identity.numbered_canonical(identity.canonical(e.fragments)).select("doc_id", "id", "display_name")


@query(
    "candidate_ids",
    "select doc_id, 'candidate-' || lpad(cast(row_number() over (partition by doc_id order by entity_type, value) as varchar), 6, '0') as id, value as candidate_key from (select doc_id, entity_type, value from frags where source_kind = 'semantic_entity_mention' group by 1, 2, 3 having count(*) >= 2)",
    *OBSERVED,
)
def _(e: Edition) -> DataFrame:
    return identity.numbered_candidates(identity.candidate_groups(identity.named(e.entities))).select("doc_id", "id", "candidate_key")


@query("item_blocks", "select doc_id, item, block_id, cast(row_number() over (partition by doc_id, item order by n) as int) as ordinal from assigned where item > 0", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    return views.member_ordinals(e.items)


@query(
    "first_processes",
    "select doc_id, item, process_number, place from (select doc_id, item, process_number, row_number() over (partition by doc_id, item order by process_number) as place from (select distinct doc_id, item, process_number from process_items)) where place <= 12",
    *OBSERVED, PROCESS_ITEMS,
)
def _(e: Edition) -> DataFrame:
    return views.first_per_group(e.process_items.select("doc_id", "item", "process_number").distinct(), ["doc_id", "item"], ["process_number"], 12, "place").withColumn("place", F.col("place").cast("long"))


@query(
    "same_document",
    "select doc_id, count(*) as blocks from blocks group by 1",
)
def _(e: Edition) -> DataFrame:
    hashes = e.blocks.groupBy("doc_id").agg(F.count("*").alias("blocks")).withColumn("sha256", F.sha2(F.col("doc_id").cast("string"), 256))
    return identity.same_document(hashes, hashes.select("doc_id", "sha256")).drop("sha256")


@query(
    "dry_run",
    """select b.doc_id, 'dodf:' || b.doc_id as document_key, sha256(cast(b.doc_id as varchar)) as document_sha256, b.pages, b.blocks, coalesce(m.c, 0) as mentions, coalesce(m.missing, 0) as missing_blocks from (select doc_id, count(distinct page) as pages, count(*) as blocks from blocks where ord % 20 <> 6 group by 1) b
left join (select m.doc_id, count(*) as c, count(distinct case when x.block_id is null then m.block_id end) as missing from mentions m left join (select doc_id, block_id from blocks where ord % 20 <> 6) x on m.doc_id = x.doc_id and m.block_id = x.block_id group by 1) m on b.doc_id = m.doc_id""",
    MENTIONS,
)
def _(e: Edition) -> DataFrame:
    manifest = e.blocks.select("doc_id").distinct().select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"), F.sha2(F.col("doc_id").cast("string"), 256).alias("sha256"))
    return dry_run(manifest, e.blocks.filter("ord % 20 <> 6"), e.mentions)


@query("explorer_related_items", "select g.doc_id, g.entity_type, g.name, i.item, i.title from (select doc_id, entity_type, value_normalized as name, unnest(list_sort(list_distinct(list(item)))[1:8]) as item from ents where entity_type <> 'organization' group by 1, 2, 3) g join full_items i on g.doc_id = i.doc_id and g.item = i.item", *OBSERVED)
def _(e: Edition) -> DataFrame:
    return views.related_items(e.titled)


@query("explorer_search", "select doc_id, item, item_type, title from (select * from full_items where contains(lower(strip_accents(title || ' ' || item_type || ' ' || array_to_string(breadcrumb, ' ') || ' ' || text)), 'sicrano avila') and item_type = 'portaria') order by doc_id, item limit 150", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    rows = e.items.select("doc_id", "item", "item_type", "title", "breadcrumb", "text")
    return views.search(rows, "Sicrano Ávila", ["title", "item_type", "breadcrumb", "text"], "item_type", "portaria").select("doc_id", "item", "item_type", "title")


@query("explorer_facets", "select item_type as facet, count(*) as rows from full_items group by 1", *SEGMENTED)
def _(e: Edition) -> DataFrame:
    return views.facets(e.items, "item_type")


@query("evidence_pane", "select a.doc_id, a.block_id, verb, a.start, substr(b.text, 1, a.start) as before, substr(b.text, a.start + 1, a.end_ - a.start) as literal, substr(b.text, a.end_ + 1) as after from acts a join blocks b on a.doc_id = b.doc_id and a.block_id = b.block_id", *SEGMENTED, ACTIONS)
def _(e: Edition) -> DataFrame:
    return views.evidence(e.actions.select("doc_id", "block_id", "verb", "start", "end"), e.blocks).drop("end")


@query("markdown", "select doc_id, string_agg(case role when 'h1' then '# ' when 'h2' then '## ' when 'h3' then '### ' else '' end || text, chr(10) || chr(10) order by page, ord) || chr(10) as markdown from blocks where not noise and text <> '' group by 1")
def _(e: Edition) -> DataFrame:
    return layout.markdown(e.blocks)


@query("markdown_with_pages", "select doc_id, string_agg(l, chr(10) || chr(10) order by page, ord) || chr(10) as markdown from (select doc_id, page, ord, case role when 'h1' then '# ' when 'h2' then '## ' when 'h3' then '### ' else '' end || text as l from blocks where not noise union all select distinct doc_id, page, 0, '<!-- pagina ' || page || ' -->' from blocks) group by 1")
def _(e: Edition) -> DataFrame:
    return layout.markdown(e.blocks, page_markers=True)


NUMBERED_FRAGMENTS = """
n_ments as (select *, 'processo_sei-' || lpad(cast(row_number() over (partition by doc_id order by page, ord, start) as varchar), 6, '0') as id from mentions),
n_all as (select doc_id, 0 as kind, id as source_id, entity_type, block_id, start, trim(regexp_replace(upper(strip_accents(value_normalized)), '[^A-Z0-9]+', ' ', 'g')) as value, cast(null as boolean) as valid from n_ents
  union all select doc_id, 1, id, 'process', block_id, start, value_normalized, true from n_ments
  union all select doc_id, 2, id, 'legal_organization', block_id, start, regexp_replace(value_normalized, '\\D', '', 'g'), valid from n_refs where reference_type = 'cnpj'),
n_frags as (select *, row_number() over (partition by doc_id order by kind, source_id) as number, row_number() over (partition by doc_id, kind > 0 order by kind, source_id) as number_of_kind from n_all)"""


@query(
    "fragment_ids",
    """select doc_id, 'fragment-' || lpad(cast(number as varchar), 6, '0') as id, source_id, case when kind = 0 then 'assertion-' else 'identifier-' end || lpad(cast(number_of_kind as varchar), 6, '0') as observation_id from n_frags""",
    *OBSERVED, NUMBERED, NUMBERED_FRAGMENTS,
)
def _(e: Edition) -> DataFrame:
    found = checkpointed(artifacts.fragments(e))  # it is read three times
    seen = identity.numbered_assertions(found).unionByName(identity.numbered_identifiers(found), allowMissingColumns=True)
    return found.select("doc_id", "id", "source_id").join(seen.select("doc_id", F.col("fragment_id").alias("id"), F.col("id").alias("observation_id")), ["doc_id", "id"])


@query(
    "link_ids",
    """select doc_id, 'link-' || lpad(cast(row_number() over (partition by doc_id order by kind, value, number) as varchar), 6, '0') as id, 'fragment-' || lpad(cast(number as varchar), 6, '0') as fragment_id,
  'canonical-' || lpad(cast(dense_rank() over (partition by doc_id order by kind, value) as varchar), 6, '0') as target from n_frags where kind > 0 and valid
union all select doc_id, 'case-' || lpad(cast(row_number() over (partition by doc_id order by number) as varchar), 6, '0'), 'fragment-' || lpad(cast(number as varchar), 6, '0'), 'UNRESOLVED' from n_frags where kind = 2 and not valid""",
    *OBSERVED, NUMBERED, NUMBERED_FRAGMENTS,
)
def _(e: Edition) -> DataFrame:
    found = checkpointed(identity.numbered_identified(e.assigned))  # it is read twice
    links = identity.numbered_links(found).select("doc_id", "id", "fragment_id", F.col("canonical_entity_id").alias("target"))
    return links.unionByName(identity.numbered_cases(found).select("doc_id", "id", "fragment_id", F.lit("UNRESOLVED").alias("target")))


@query("context_ids", "select doc_id, 'context-' || lpad(cast(context as varchar), 4, '0') as id, string_agg(text, ' ' order by n) as label, 'section-' || lower(any_value(section)) as section_id from assigned where context > 0 group by doc_id, context", FLAGS)
def _(e: Edition) -> DataFrame:
    return e.contexts.select("doc_id", F.format_string("context-%04d", "context").alias("id"), "label", F.concat(F.lit("section-"), F.lower("section")).alias("section_id"))


def _sources(e: Edition) -> DataFrame:
    documents = e.assigned.select("doc_id").distinct()
    return documents.select("doc_id", F.concat(F.lit("repo:///d"), "doc_id").alias("uri"), F.concat(F.lit("repo:///m"), "doc_id").alias("mentions_uri"), F.sha2(F.col("doc_id").cast("string"), 256).alias("sha256"))


def _damaged(rows: DataFrame, ways: list) -> DataFrame:
    """Artifacts, those of each remainder of doc_id changed in the way of that place."""
    text = F.col("artifact")
    changed = text
    for i, way in enumerate(ways):
        changed = F.when(F.col("doc_id") % len(ways) == i, way(text)).otherwise(changed)
    return rows.select("doc_id", changed.alias("artifact"))


def _swap(old: str, new: str):
    return lambda text: F.replace(text, F.lit(old), F.lit(new))


def _contract(ways: list[tuple]) -> tuple[list, str]:
    """The ways, and SQL that gives path and rule of each."""
    n = len(ways)
    cases = " ".join(f"when doc_id % {n} = {i} then {path}" for i, (_, path, _) in enumerate(ways) if path)
    rules = " ".join(f"when doc_id % {n} = {i} then '{rule}'" for i, (_, path, rule) in enumerate(ways) if path)
    return [w for w, _, _ in ways], f"select doc_id, path, rule from (select doc_id, case {cases} end as path, case {rules} end as rule from known) where path is not null"


SEMANTIC_WAYS, SEMANTIC_SQL = _contract([
    (lambda text: text, None, None),
    (_swap('"schema_version":"1.0"', '"schema_version":"2.0"'), "'schema_version'", "const"),
    (lambda text: F.regexp_replace(text, r',"counts":\{[^}]*\}\}$', "}"), "'<root>'", "required"),
    (_swap('{"schema_version"', '{"extra":[],"schema_version"'), "'<root>'", "additionalProperties"),
    (_swap('"kind":"article"', '"kind":"clause"'), "case when provisions > 0 then 'provisions.0.kind' end", "const"),
    (_swap('"entity_type":"person"', '"entity_type":"human"'), "case when persons > 0 then 'entity_mentions.' || organisations || '.entity_type' end", "enum"),
    (lambda text: F.regexp_replace(text, r'"page":\d+', '"page":0'), "case when actions > 0 then 'actions.0.page' when contexts > 0 then 'editorial_contexts.0.page' when provisions > 0 then 'provisions.0.page' end", "minimum"),
    (lambda text: F.regexp_replace(text, r'"document_sha256":"[0-9a-f]{8}', '"document_sha256":"SHA256: '), "'source.document_sha256'", "pattern"),
    (lambda text: _swap('{"schema_version":"1.0"', '{"extra":1,"schema_version":1')(text), "'<root>'", "additionalProperties"),
    (_swap('"valid":true', '"valid":"yes"'), "case when first_valid > 0 then 'references.' || (first_valid - 1) || '.valid' end", "type"),
    (lambda text: F.regexp_replace(text, r'"block_ids":\[[^\]]*\]', '"block_ids":[]'), "case when contexts > 0 then 'editorial_contexts.0.block_ids' when items > 0 then 'published_items.0.block_ids' end", "minItems"),
    (lambda text: F.concat(F.lit("x"), text), "'<root>'", "json"),
])
KNOWN = """known as (select d.doc_id, coalesce(p.n, 0) as provisions, coalesce(a.n, 0) as actions, coalesce(e.persons, 0) as persons, coalesce(e.organisations, 0) as organisations, coalesce(e.organisations, 0) as contexts, coalesce(r.first_valid, 0) as first_valid, coalesce(i.n, 0) as items
  from (select distinct doc_id from assigned) d left join (select doc_id, count(*) as n from n_prov group by 1) p using (doc_id) left join (select doc_id, count(*) as n from n_acts group by 1) a using (doc_id)
  left join (select doc_id, count(*) filter (where entity_type = 'person') as persons, count(*) filter (where entity_type = 'organization') as organisations from n_ents group by 1) e using (doc_id)
  left join (select doc_id, min(cast(id[11:] as int)) filter (where valid) as first_valid from n_refs group by 1) r using (doc_id)
  left join (select doc_id, count(*) as n from full_items group by 1) i using (doc_id))"""


@query("semantic_contract", SEMANTIC_SQL, *OBSERVED, NUMBERED, KNOWN)
def _(e: Edition) -> DataFrame:
    made = artifacts.semantic(e, _sources(e), "2026-06-22T00:00:00+00:00")
    return schemas.violations(_damaged(made, SEMANTIC_WAYS), "artifact", formats.SEMANTIC, "semantic-document", ["doc_id"]).select("doc_id", "path", "rule")


IDENTITY_WAYS, IDENTITY_SQL = _contract([
    (lambda text: text, None, None),
    (_swap('"default":"KEEP_SEPARATE"', '"default":"MERGE"'), "'policy.default'", "const"),
    (_swap('"has_divergence":false', '"has_divergence":0'), "case when links > 0 then 'identity_links.0.has_divergence' end", "const"),
    (_swap('"scope":null,', ""), "case when assertions > 0 then 'assertions.0' end", "required"),
    (_swap('"is_valid":false', '"is_valid":"no"'), "case when first_invalid > 0 then 'identifiers.' || (first_invalid - 1) || '.is_valid' end", "type"),
    (_swap('"materiality_classes":["N"]', '"materiality_classes":["N","Q"]'), "case when candidates > 0 then 'candidate_groups.0.materiality_classes.1' end", "enum"),
    (lambda text: F.regexp_replace(text, r'"fragments":\d+', '"fragments":-1'), "'counts.fragments'", "minimum"),
    (lambda text: F.regexp_replace(text, r'"principles":\["(\w+)",', '"principles":["links_are_reversible_and_versioned",'), "'policy.principles'", "uniqueItems"),
])
KNOWN_IDENTITY = """known as (select doc_id, count(*) filter (where kind > 0 and valid) as links, count(*) filter (where kind = 0) as assertions, coalesce(min(number_of_kind) filter (where kind = 2 and not valid), 0) as first_invalid, any_value(coalesce(c.n, 0)) as candidates
  from n_frags left join (select doc_id, count(*) as n from (select doc_id from n_frags where kind = 0 group by doc_id, entity_type, value having count(*) > 1) group by 1) c using (doc_id) group by doc_id)"""


@query("identity_contract", IDENTITY_SQL, *OBSERVED, NUMBERED, NUMBERED_FRAGMENTS, KNOWN_IDENTITY)
def _(e: Edition) -> DataFrame:
    made = artifacts.identities(checkpointed(artifacts.fragments(e)), _sources(e), "2026-06-22T00:00:00+00:00")
    return schemas.violations(_damaged(made, IDENTITY_WAYS), "artifact", formats.IDENTITY, "identity-resolution", ["doc_id"]).select("doc_id", "path", "rule")


@query(
    "rules_in_sql",
    "select reference_type as rule, doc_id, block_id, start, end_ as \"end\", value_original as value from refs union all select 'article', doc_id, block_id, start, end_, value from provisions",
    *SEGMENTED, REFERENCES, PROVISIONS,
)
def _(e: Edition) -> DataFrame:
    """References and provisions of items, found by SQL functions that stand in LATERAL."""
    spark = e.blocks.sparkSession
    names = [*observations.METHODS, "article"]
    rules.register(spark, [Rule(k, V.PATTERNS[k]) for k in names])
    members = checkpointed(e.assigned.filter("item > 0").select("doc_id", "block_id", "text"))  # it is read by each rule
    parts = [f"select m.rule, b.doc_id, b.block_id, m.start, m.end, m.value from {{blocks}} b, lateral find_{k}(b.text) m" for k in names]
    return spark.sql(" union all ".join(parts), blocks=members)
