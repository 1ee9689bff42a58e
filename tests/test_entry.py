"""Every query runs on the smallest tables and gives the rows of its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SOME = ["mentions_by_rule", "published_items", "entity_mentions", "identity_counts", "explorer_entities", "block_layout", "html_blocks", "annotation_violations", "lineage_ancestry", "edition_keys"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def values(rows, columns, order):
    return sorted(tuple(repr(round(r[columns.index(c)], 9) if isinstance(r[columns.index(c)], float) else r[columns.index(c)]) for c in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_query_gives_what_sql_gives(spark, name):
    df = entry.queries()[name](spark, SF)
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    order = sorted(df.columns)
    assert values([tuple(r) for r in df.collect()], df.columns, order) == values(want.fetchall(), want.columns, order)


def test_names(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
