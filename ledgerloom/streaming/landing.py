"""An extension: documents that arrive in a folder, run through the batch operators.

A document is named by its hash. One that arrives again within a day of the first is dropped; one
that arrives later is written again, under its hash, and `latest` keeps the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.spans import Rule
from ledgerloom.operators import mentions as M


def arrivals(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """Rows of Parquet files as they land, with an id by content; late repeats inside a day are dropped."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    rows = rows.withColumn("sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn("seen_at", F.current_timestamp())
    return rows.withWatermark("seen_at", "1 day").dropDuplicatesWithinWatermark(["sha256"])


def mention_stream(rows: DataFrame, blocks: Callable[[DataFrame], DataFrame], rules: list[Rule]) -> DataFrame:
    """Mentions of arriving documents; no state beyond the arrivals' own."""
    return M.mentions(blocks(rows), rules)


def into_table(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's rows below path, in a folder named by the batch, so a batch that is run again overwrites itself only."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(written: DataFrame, key: list[str]) -> DataFrame:
    """Of what into_table wrote (with its column batch) each document's rows of its last batch; key names a document."""
    last = written.groupBy(*key).agg(F.max("batch").alias("batch"))
    return written.join(last, [*key, "batch"], "left_semi")
