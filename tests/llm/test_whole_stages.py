"""The pipeline's stages are written as Parquet below spark.checkpoint.dir and read again."""

from __future__ import annotations

import os

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_are_files(spark):
    files = corpus_pipeline.run(spark, SF).inputFiles()
    assert files and all(f"{spark.conf.get('spark.checkpoint.dir')}/stage-" in f and f.endswith(".parquet") for f in files)
