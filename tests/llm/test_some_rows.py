"""Batches of texts are looked at in pieces."""

from __future__ import annotations

import pyarrow as pa
from ledgerloom.llm import common


def test_slices_give_all_rows_in_order_and_few_at_a_time():
    batches = [pa.RecordBatch.from_pydict({"x": list(range(first, first + n))}) for first, n in ((0, 600), (600, 0), (600, 5))]
    found = list(common.slices(iter(batches), 256))
    assert [b.num_rows for b in found] == [256, 256, 88, 5]
    assert [x for b in found for x in b.column("x").to_pylist()] == list(range(605))
