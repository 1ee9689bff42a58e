"""Operator 5 on very long texts, columns with clashing names, empty part lists and equal turns."""

from __future__ import annotations

import hashlib

from ledgerloom.llm import chat


def test_long_texts_clashing_names_and_ties(spark):
    long = "\\#<" * 50_000 + "é🙂"
    rows = [(1, 0, "user", long, "x", "y"), (1, 1, "assistant", long, "x", "y"), (2, 0, "assistant", "b", None, None), (2, 0, "assistant", "a", None, None), (2, 0, "assistant", "a", None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ord string, seen string")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(chat.text_messages(frame))).collect()}
    assert got[1].loss_chars == len(long) and got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[2].n_turns == 3 and got[2].loss_sha256 == hashlib.sha256(b"aab").hexdigest()  # ties by text, repeated turns stay


def test_empty_and_missing_parts(spark):
    rows = [(1, 0, "user", []), (1, 1, "assistant", None), (1, 2, "assistant", [(None, None, None, None, None, None, None)]), (1, 3, "tool", [("image", None, None, None, None, None, None)])]
    made = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).first()
    assert made.formatted == "### User: </turn>\n### Assistant: </turn>\n### Assistant: </turn>\n### \\rtool: <|image:1|></turn>\n"
    assert made.attachment_tokens == 1 and [x.length for x in made.loss] == [0, 0]
