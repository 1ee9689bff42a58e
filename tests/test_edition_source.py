"""The data source of editions: same blocks as the readers, filters taken over, all or nothing when writing."""

from __future__ import annotations

import json
import os

import pytest
from ledgerloom.sources import documents as D
from ledgerloom.sources import editions
from pyspark.sql import functions as F


def edition(n, pages):
    blocks = lambda p: [{"id": f"p{p:04d}-b{i:04d}", "order": i, "text_normalized": f"  é {n} {p} {i} " if i % 3 else None, "markdown_role": [None, "h1", "h2"][i % 3], "removed_as_noise": [None, True, False][i % 3]} for i in range(1, 6)]
    return {"schema_version": "1.0", "source": {"sha256": f"{n:064x}"}, "pages": [{"number": p, "blocks": blocks(p)} for p in range(1, pages + 1)]}


@pytest.fixture
def folder(tmp_path):
    for n in range(7):
        (tmp_path / "in" / f"y{n % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"y{n % 2}" / f"e{n}.json").write_text(json.dumps(edition(n, n)))
    (tmp_path / "in" / "_tmp").mkdir()
    (tmp_path / "in" / "_tmp" / "x.json").write_text("no json")
    (tmp_path / "in" / "note.txt").write_text("no json")
    return str(tmp_path / "in")


def test_same_blocks_as_the_readers(spark, folder):
    editions.register(spark)
    got = spark.read.format("editions").option("bytesPerTask", 3000).load(folder)
    want = D.flatten(D.read_structured(spark, f"{folder}/y*/*.json"))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 105
    assert got.rdd.getNumPartitions() > 3
    some = lambda rows: rows.filter((F.col("page") == 2) & F.col("role").isin("h1", "h2") & (F.col("ord") > 1) & ~F.col("noise"))
    assert sorted(map(tuple, some(got).collect())) == sorted(map(tuple, some(want).collect()))


def test_filters_are_taken_over(folder):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = editions.EditionReader({"path": folder})
    rest = GreaterThan(("ord",), 1)
    assert list(reader.pushFilters([EqualTo(("page",), 2), In(("role",), ("h1", "h2")), rest])) == [rest]
    rows = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert len(rows) == 20 and {r["page"] for r in rows} == {2} and {r["role"] for r in rows} <= {"h1", "h2"}
    assert list(editions.EditionReader({"path": folder}).pushFilters([EqualTo(("text",), "x")])) != []


def test_documents_are_written_all_or_none(spark, tmp_path):
    editions.register(spark)
    out = tmp_path / "out"
    out.mkdir()
    rows = spark.range(6).select(F.concat(F.lit("e"), "id").alias("name"), F.format_string('{"b": [%d, null], "a": "é"}', "id").alias("text")).repartition(3)
    rows.write.format("editions").mode("append").save(str(out))
    assert sorted(os.listdir(out)) == ["_staging"] + [f"e{i}.json" for i in range(6)] or sorted(x for x in os.listdir(out) if x[0] != "_") == [f"e{i}.json" for i in range(6)]
    assert (out / "e3.json").read_text() == '{"b":[3,null],"a":"é"}\n'
    bad = rows.withColumn("text", F.when(F.col("name") == "e5", "no json").otherwise(F.lit("{}")))
    with pytest.raises(Exception, match="."):
        bad.write.format("editions").mode("append").save(str(out))
    twice = rows.withColumn("name", F.lit("e0"))
    with pytest.raises(Exception, match="one name"):
        twice.write.format("editions").mode("append").save(str(out))
    assert (out / "e5.json").read_text() == '{"b":[5,null],"a":"é"}\n' and not [x for _, _, files in os.walk(out / "_staging") for x in files]
    rows.filter("name < 'e2'").write.format("editions").option("pretty", True).mode("overwrite").save(str(out))
    assert sorted(x for x in os.listdir(out) if x[0] != "_") == ["e0.json", "e1.json"] and (out / "e1.json").read_text().startswith('{\n  "b"')
