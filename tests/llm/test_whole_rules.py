"""Operator 4 finds every pattern rule that its SQL finds, whichever alternative of it a url has."""

from __future__ import annotations

import duckdb
from ledgerloom.llm import urls


def test_alternatives_and_open_ends(spark):
    pages = ["https://a.org/signin", "https://a.org/login?x=1", "https://a.org/login/signin", "https://blog.a.org/x/1.htmlx", "https://blog.a.org/x/1.html", "https://a.org/x", None]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = urls.filter_urls(df, *urls.rule_frames(spark))
    c = duckdb.connect()
    c.sql("create table pages (page_id bigint, url varchar)")
    c.executemany("insert into pages values (?, ?)", list(enumerate(pages)))
    want = c.sql(urls.oracle())
    assert sorted(map(repr, (tuple(r) for r in got.select(want.columns).collect()))) == sorted(map(repr, want.fetchall()))
    assert {r.page_id: r.pattern_rule for r in got.collect()} == {0: "login", 1: "login", 2: "login", 3: "blog_page", 4: "blog_page", 5: None, 6: None}
