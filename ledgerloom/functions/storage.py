"""Cutting lineage: what is written once and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder of its own below spark.checkpoint.dir; where that is unset one of this machine, in one process only."""
    return f"{_base(spark)}/{kind}-{uuid.uuid4().hex}"


def _base(spark: SparkSession) -> str:
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if folder is None and not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix="checkpoints-")


def checkpointed(df: DataFrame, placed: bool = False) -> DataFrame:
    """df written to spark.checkpoint.dir and read back.

    Where that is unset a folder of this machine serves if Spark runs in one process, as in tests;
    on a cluster it would be lost with an executor, so there it is an error.
    placed: the rows are known to lie where df's last shuffle put them, so that groups and joins by its keys need no other. An
    adaptive plan doesn't tell that, so this one isn't adaptive; and names that a subquery qualified are lost when a table is read twice, so columns have other names meanwhile.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(_base(spark))
    # Spark 4.1 may take a union's parts for partitioned alike after they have been coalesced apart; joins of it then fail
    meanwhile = {"spark.sql.unionOutputPartitioning": "false"} | ({"spark.sql.adaptive.enabled": "false"} if placed else {})
    before = {k: spark.conf.get(k) for k in meanwhile}
    try:
        for k, v in meanwhile.items():
            spark.conf.set(k, v)
        if not placed:
            return df.checkpoint(eager=True)
        return df.toDF(*(f"{c}_" for c in df.columns)).checkpoint(eager=True).toDF(*df.columns)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def placed(df: DataFrame) -> DataFrame:
    """checkpointed with placed."""
    return checkpointed(df, placed=True)
