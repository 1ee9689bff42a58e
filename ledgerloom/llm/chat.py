r"""Chat formatting (operator 5), in DataFrame operations only.

A message holds ordered, typed parts: text, image, audio or document. A visitor flattens them into
one string, text escaped and every other part replaced by a numbered placeholder; what a
placeholder stands for is recorded with the number of tokens that it will expand to.

A turn is written `### Role: content</turn>` and a newline. Inside content and role names three
characters are escaped, so no control string can appear there and reading back is exact:
`\` as `\\`, `#` as `\h`, `<` as `\l`. Placeholders are `<|image:1|>` and so on, counted over the
conversation in order. The loss mask lists (start, length) in code points of assistant content.

A turn's pieces are made row by row and their places by a running sum, so a conversation's rows
come together only for its one output string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
#: Shown names of the usual roles; any other role is written escaped behind `\r`.
ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse: between doubled backslashes, a backslash can only begin \\h or \\l."""
    back = lambda x: F.replace(F.replace(x, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), back), "\\")


def role_name(role: Column) -> Column:
    out = F.concat(F.lit("\\r"), F.replace(escape(role), F.lit(":"), F.lit("\\c")))
    for role_, name in ROLES.items():
        out = F.when(role == role_, name).otherwise(out)
    return out


def role_from_name(name: Column) -> Column:
    # of `\\`, `\h`, `\l`, `\c` only the last is the role's own
    halves = F.transform(F.split(name.substr(F.lit(3), F.length(name)), r"\\\\"), lambda x: F.replace(x, F.lit("\\c"), F.lit(":")))
    out = unescape(F.array_join(halves, "\\\\"))
    for role_, shown in ROLES.items():
        out = F.when(name == shown, role_).otherwise(out)
    return out


def part_tokens(part: Column, patch: int = 28, per_second: float = 12.5, per_page: int = 256) -> Column:
    """Tokens that a placeholder expands to: patches of an image, frames of audio, pages of a document; at least 1."""
    size = (
        F.when(part["kind"] == "image", F.ceil(F.coalesce(part["width"], F.lit(1)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(1)) / patch))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * per_second))
        .otherwise(F.coalesce(part["pages"], F.lit(1)) * per_page)
    )
    return F.greatest(F.lit(1), size.cast("long")).cast("long")


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"] == "text", F.lit(True))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation of messages (conv_id, turn, role, parts: array of PART).

    Returns conv_id, n_turns, formatted, loss (array of start and length in code points, from 0),
    attachments (array of number, kind, ref, tokens), attachment_tokens. Turns come in order of
    turn, role and parts, so ties have one result; repeated rows are turns too. A null role, text
    or part list is empty; a part without kind is text; a null conv_id is a conversation as well.
    """
    parts = F.coalesce("parts", F.expr(f"cast(array() as array<{PART}>)"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.withColumn("media", F.filter("parts", lambda p: ~is_text(p)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", F.transform("parts", lambda p: F.coalesce(p["text"], p["ref"], F.lit(""))))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ord", F.row_number().over(order)).withColumn("seen", F.coalesce(F.sum(F.size("media")).over(before), F.lit(0)))

    def visit(part: Column, i: Column) -> Column:
        number = F.col("seen") + F.size(F.filter(F.slice("parts", 1, i), lambda q: ~is_text(q))) + 1
        mark = F.concat(F.lit("<|"), F.replace(escape(part["kind"]), F.lit(":"), F.lit("\\c")), F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)

    body = F.array_join(F.transform("parts", visit), "")
    rows = rows.withColumn("head", F.concat(F.lit("### "), role_name(F.col("role")), F.lit(": "))).withColumn("body", body)
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END)))
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head")
    # window order needs `parts` only as a tie-break; the second window reuses the first one's order
    rows = rows.withColumn("span", F.when(F.col("role") == "assistant", F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("length"))))
    held = F.transform(
        "media",
        lambda p, i: F.struct((F.col("seen") + i + 1).cast("long").alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")),
    )
    turns = F.array_sort(F.collect_list(F.struct("ord", "piece", "span", held.alias("held"))))
    out = rows.groupBy("conv_id").agg(turns.alias("turns"))
    out = out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
        F.flatten(F.col("turns.held")).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return out.withColumn("attachment_tokens", total)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns again, from `formatted` and `loss` alone: conv_id, ord (from 0), role, text, in_loss (text under the mask).

    A conversation's turns become rows; nothing is searched for across turns, so long ones stay linear.
    """
    rows = formatted.select("conv_id", "formatted", "loss", F.posexplode(F.split("formatted", END)).alias("ord", "piece"))
    rows = rows.filter(F.col("piece") != "").select("conv_id", "ord", "piece")
    order = Window.partitionBy("conv_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long") + len(END)).over(order), F.lit(0))
    rows = rows.withColumn("start", start)
    head = F.instr("piece", ": ")
    rows = rows.withColumn("name_", F.substring("piece", F.lit(5), head - 5)).withColumn("body", F.substring("piece", head + 2, F.length("piece")))
    rows = rows.withColumn("body_start", F.col("start") + head + 1)
    spans = formatted.select("conv_id", F.explode("loss").alias("span")).select(F.col("conv_id").alias("id"), F.col("span.start").alias("at"), F.col("span.length").alias("length"))
    rows = rows.join(spans, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("body_start") == F.col("at")), "left")
    masked = F.when(F.col("length").isNotNull(), unescape(F.substring("body", F.lit(1), F.col("length").cast("int"))))
    return rows.select("conv_id", "ord", role_from_name(F.col("name_")).alias("role"), unescape(F.col("body")).alias("text"), masked.alias("in_loss"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 as read back from the output, formatted_chars."""
    turns = F.array_sort(F.collect_list(F.struct("ord", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "in_loss")))
    out = read_back(formatted).groupBy("conv_id").agg(turns.alias("t"))
    loss = F.array_join(F.filter(F.col("t.in_loss"), lambda x: x.isNotNull()), "")
    out = out.select(
        F.col("conv_id").alias("id"),
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.col("t.turn"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
    )
    sizes = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "attachment_tokens")
    return sizes.join(out, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id", "attachment_tokens")


def text_messages(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages of one text part each; a null text is empty."""
    part = F.expr(f"cast(named_struct('kind', 'text', 'text', coalesce(text, ''), 'ref', null, 'width', null, 'height', null, 'seconds', null, 'pages', null) as {PART})")
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


ORACLE = r"""
with extra(conv_id, turn, role, text) as (values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select * from extra),
e as (select *, length(replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l')) as body,
  case role when 'user' then 4 when 'assistant' then 9 when 'system' then 6
  else 2 + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '<', '\l'), ':', '\c')) end as name from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(body + name + 14) as bigint) as formatted_chars
from e group by conv_id
"""
