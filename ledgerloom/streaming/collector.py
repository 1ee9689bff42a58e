"""An extension: a collector's memory as keyed state, so that it goes on after a restart where it stopped.

Fetches of documents arrive in any order: document, source, fetched_at, status, sha256. For each document the state holds its newest
version and its failures. What comes out are events:

    version   a hash that differs from the one fetched before it; number counts the document's versions
    late      a fetch older than the newest version: it becomes part of the history, not the current text
    retry     a failed fetch; due is when to try again: BACKOFF seconds, doubled with each failure in a row
    due       that time has come and no fetch has arrived since; the timer is in event time, set off by the watermark
    given_up  MOST failures in a row

Everything depends on the fetches' own times, so a stream that is stopped and started again gives the events
that one run gives. State is one row per document, kept by Spark in its state store (RocksDB) with the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FETCHES = "document string, source string, fetched_at timestamp, status int, sha256 string"
EVENTS = "document string, event string, at timestamp, number int, sha256 string, due timestamp"
STATE = "number int, sha256 string, newest_ms long, failures int, due_ms long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BACKOFF, MOST = 60, 5


class Collector(StatefulProcessor):
    def __init__(self, backoff: int = BACKOFF, most: int = MOST):
        self.backoff, self.most = backoff, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        number, sha, newest, failures, due = self.known.get() if self.known.exists() else (0, None, -1, 0, -1)
        fetched = pd.concat(list(rows)).sort_values(["fetched_at", "status", "sha256"])
        out = []
        tell = lambda event, at, number=None, sha=None, due=None: out.append((key[0], event, at, number, sha, due))
        before = due
        for at, status, digest in zip(fetched["fetched_at"], fetched["status"], fetched["sha256"], strict=True):
            ms = int(at.timestamp() * 1000)
            if 0 <= due <= ms:  # the time came before this fetch
                tell("due", pd.Timestamp(due, unit="ms"))
                due = -1
            if status != 200:
                failures += 1
                if failures >= self.most:
                    tell("given_up", at, failures)
                    failures, due = 0, -1
                else:
                    due = ms + 1000 * self.backoff * 2 ** (failures - 1)
                    tell("retry", at, failures, due=pd.Timestamp(due, unit="ms"))
                continue
            failures, due = 0, -1
            if ms < newest:
                tell("late", at, None, digest)
            else:
                newest = ms
                if digest != sha:
                    number, sha = number + 1, digest
                    tell("version", at, number, digest)
        if before >= 0 and before != due:
            self.handle.deleteTimer(before)
        if due >= 0 and before != due:
            self.handle.registerTimer(due)
        self.known.update((number, sha, newest, failures, due))
        yield _events(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        number, sha, newest, failures, due = self.known.get()
        out = []
        if due == expiredTimerInfo.getExpiryTimeInMs():
            out.append((key[0], "due", pd.Timestamp(due, unit="ms"), None, None, None))
            self.known.update((number, sha, newest, failures, -1))
        yield _events(out)

    def close(self) -> None:
        pass


def _events(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["document", "event", "at", "number", "sha256", "due"])
    return out.astype({"number": "Int32", "at": "datetime64[ns]", "due": "datetime64[ns]"})


def collected(fetches: DataFrame, delay: str = "10 minutes", backoff: int = BACKOFF, most: int = MOST) -> DataFrame:
    """The events of a stream of fetches; fetches that arrive more than `delay` behind the newest are left out by Spark."""
    rows = fetches.filter("document is not null and fetched_at is not null").withColumn("status", F.coalesce("status", F.lit(0))).withWatermark("fetched_at", delay)
    return rows.groupBy("document").transformWithStateInPandas(Collector(backoff, most), EVENTS, "Append", "EventTime")


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, **options) -> object:
    """Run over the files of a folder that aren't done yet, then stop; events go to out as Parquet. The query."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    fetches = spark.readStream.schema(FETCHES).json(folder)
    found = collected(fetches, **options)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
