"""A collector that is stopped and started again tells what one run tells."""

from __future__ import annotations

import json

from ledgerloom.streaming import collector


def at(minute):
    return f"2026-06-22T{10 + minute // 60:02d}:{minute % 60:02d}:00Z"


FILES = [
    [("a", 0, 200, "h1"), ("b", 0, 500, None), ("c", 0, 200, "h1"), ("c", 1, 200, "h1"), ("f", 5, 200, "h1")],
    [("a", 5, 200, "h2"), ("c", 6, 200, "h3"), ("d", 6, 500, None), ("d", 7, 500, None), ("f", 2, 200, "h0")],
    [("a", 60, 200, "h2"), ("d", 61, 200, "h9"), ("e", 62, 500, None), *[("g", 60 + 2 * i, 500, None) for i in range(5)]],
    [("z", 300, 200, "end")],
]
WANT = {
    ("a", "version", 0, 1, "h1"), ("a", "version", 5, 2, "h2"), ("c", "version", 0, 1, "h1"), ("c", "version", 6, 2, "h3"), ("f", "version", 5, 1, "h1"), ("f", "late", 2, None, "h0"),
    ("b", "retry", 0, 1, None), ("b", "due", 1, None, None), ("d", "retry", 6, 1, None), ("d", "due", 7, None, None), ("d", "retry", 7, 2, None), ("d", "due", 9, None, None),
    ("d", "version", 61, 1, "h9"), ("e", "retry", 62, 1, None), ("e", "due", 63, None, None), ("z", "version", 300, 1, "end"),
    *[("g", "retry", 60 + 2 * i, i + 1, None) for i in range(4)], ("g", "due", 61, None, None), ("g", "due", 64, None, None), ("g", "given_up", 68, 5, None),
}


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"document": d, "source": "s", "fetched_at": at(m), "status": s, "sha256": h}) for d, m, s, h in rows))


def events(spark, path):
    rows = spark.read.parquet(path).collect()
    return [(r.document, r.event, r.at.hour * 60 + r.at.minute - 600, r.number, r.sha256) for r in rows]


def test_restarts_tell_the_same(spark, tmp_path):
    steps = tmp_path / "steps"
    for i, rows in enumerate(FILES):  # a run of its own per file: each begins from the checkpoint of the one before
        put(steps, f"f{i}", rows)
        collector.start(spark, str(steps), str(tmp_path / "o1"), str(tmp_path / "c1")).awaitTermination(180)
    got = events(spark, str(tmp_path / "o1"))
    assert sorted(map(str, got)) == sorted(map(str, WANT))
    whole = tmp_path / "whole"
    for i, rows in enumerate(FILES):
        put(whole, f"f{i}", rows)
    collector.start(spark, str(whole), str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination(180)
    once = events(spark, str(tmp_path / "o2"))
    # in one run nothing is late: a document's fetches are taken in the order of their times
    assert sorted(map(str, (e for e in once if e[0] != "f"))) == sorted(map(str, (e for e in WANT if e[0] != "f")))
    assert {e[1:] for e in once if e[0] == "f"} == {("version", 2, 1, "h0"), ("version", 5, 2, "h1")}
