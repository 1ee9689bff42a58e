"""fragment_ids reads numbered fragments three times, so it writes them once."""

import os

import pytest

from ledgerloom.queries import gazette

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_fragments_are_stored_before_they_are_read_again(spark, monkeypatch):
    stored, real = [], gazette.checkpointed
    monkeypatch.setattr(gazette, "checkpointed", lambda df: stored.append(df.columns) or real(df))
    gazette.QUERIES["fragment_ids"](spark, SF)
    assert len(stored) == 1 and "source_id" in stored[0]
