"""Helpers that several operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id wherever rows are matched by id; it sorts before all others.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def twin_key(column: str = "text") -> Column:
    """Tells rows with one id apart by their texts; (id_key, twin_key) names a document."""
    return F.xxhash64(text_or_empty(column))


def own_columns(docs: DataFrame) -> DataFrame:
    """The whole row as a struct `row`, so that an operator's own columns can't clash with it."""
    return docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text")
    )


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this machine serves only where it is unset and Spark runs in one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith(("local[", "local,")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or f"{tempfile.gettempdir()}/checkpoints/{uuid.uuid4().hex}"


@contextmanager
def plain_unions(spark: SparkSession) -> Iterator[None]:
    """Inside, a union isn't taken for partitioned alike: Spark 4.1 may do so after its parts were coalesced apart, and joins of it then fail."""
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Write df to spark.checkpoint.dir and read it back, so that later jobs start from the files."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    with plain_unions(df.sparkSession):
        return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle and checkpoint files of what nothing refers to any more.

    It does so when the driver's JVM collects its garbage, which may come after the disks are full where rounds write much and leave little garbage.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet below spark.checkpoint.dir and read it back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    with plain_unions(spark):
        df.write.parquet(folder)
    return spark.read.parquet(folder)


#: A key is hot when it has more than one in HOT of all rows; so there are fewer than HOT such keys, whatever the input.
HOT = 500


def salted_join(rows: DataFrame, small: DataFrame, on: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """rows joined with small, which has n, about the number of rows with its key, in each of a key's rows; n isn't returned.

    Rows of a hot key are dealt over several partitions, in proportion to n, by a hash of their
    columns `by`, and those of small are repeated for each. What is broadcast are hot keys only, fewer than HOT. small should
    be a table (see cut), as it is read three times. how: inner or left.
    """
    total = small.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    salts = F.when(F.col("n") > total // HOT + 1, F.ceil(F.col("n") * parts(rows.sparkSession) / max(total, 1))).otherwise(1).cast("int")
    small = small.withColumn("salts_", salts).drop("n")
    hot = small.filter("salts_ > 1").select(*on, "salts_").distinct()
    if hot.isEmpty():
        return rows.join(small.drop("salts_"), on, how)
    rows = rows.join(F.broadcast(hot), on, "left")
    rows = rows.withColumn("salt_", F.pmod(F.xxhash64(*by), F.coalesce("salts_", F.lit(1))).cast("int")).drop("salts_")
    small = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.col("salts_") - 1))).drop("salts_")
    return rows.join(small, [*on, "salt_"], how).drop("salt_")


# ---------------------------------------------------------------- bytes inside a task

#: How many bytes of text are looked at together; it bounds a task's arrays.
CHUNK = 1 << 20


def chunks(texts: Iterable[bytes | None], limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of runs of texts that hold about `limit` bytes; null is empty."""
    held: list[bytes] = []
    size, first = 0, 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > limit:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


#: How many rows are copied into Python at a time.
ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of some rows, so that of a batch's texts only a few are Python objects; at the end Arrow's free memory goes back.

    A Python worker lives on for later stages, and what it holds is added to what the JVM takes then.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def joined(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """The texts behind one another, each ended by a gap byte, and where each begins (and the end)."""
    buffer = np.frombuffer(gap.join([*texts, b""]), dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return buffer, begins


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a sum of products counts."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, CHUNK + 64)
        up = np.full(n, _BASE, dtype=np.uint64)
        down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[:1] = down[:1] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
        if n > 8 * CHUNK:  # one very long text; its tables are not kept
            return _POWERS.pop(0), _POWERS.pop(0)
    return _POWERS[0], _POWERS[1]


def runs(buffer: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of one kind; kind 0 separates and belongs to no run."""
    kind = kinds[buffer]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    edges = np.concatenate(([0], change, [len(kind)])) if len(kind) else np.zeros(1, dtype=np.int64)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] != 0
    return starts[real], ends[real]


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    up, down = _powers(len(buffer) + 1)
    prefix = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each position on; n - 1 fewer than words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    total = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        total = total * np.uint64(0xA0761D6478BD642F) + words[k : len(words) - n + 1 + k]
    return mix(total)


# ---------------------------------------------------------------- a filter of one size

#: log2 of the bits of a filter.
BITS = 24


def _bit(key: np.ndarray) -> np.ndarray:
    return (mix(key.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """2 ** BITS bits in bytes (2 MB), one set for every value of a long column: a filter without false negatives, of one size whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique(_bit(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 5), pa.array(np.int64(1) << (bit & 31))], names=["word", "bits"])

    words = rows.select(column).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (BITS - 5), dtype=np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def in_bitmap(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key may be in a bitmap."""
    bit = _bit(key)
    return (bits[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
