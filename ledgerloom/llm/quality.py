"""Quality classifier (operator 6): logistic regression on hashed word n-grams.

Words are runs of letters and digits, or of other signs; case counts. A text's features are its
hashed words and pairs of words (all pairs of a word with itself are one feature), each weighted by
its share of them, so a score is one sparse dot product and a text's length doesn't matter. Training follows the regularised leader (FTRL-proximal)
on shards of the labelled rows, in tasks of their own, and averages the shards' weights by feature.

What is bounded: the labelled rows that training reads (MAX_TRAINED, the smallest hashes of their
ids) and the number of weights (2 ** BITS), which is what goes to the driver and to every task.
Every row of the table is scored, from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import chunks, gram_hashes, joined, runs, span_hashes

BITS, MAX_TRAINED, SHARDS, EPOCHS = 18, 20_000, 8, 4
#: Of FTRL: learning rate, smoothing, and the two penalties. SCALE stretches the shares.
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 1e-4, 1e-4, 10.0

#: The feature of a word that comes again at once, or after one other, whatever the word is.
REPEATED = np.uint64(0x5BD1E995)

_KINDS = np.full(256, 2, dtype=np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = 0
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts behind one another, and how many each text has."""
    buffer, begins = joined(texts)
    starts, ends = runs(buffer, _KINDS)
    words = span_hashes(buffer, starts, ends)
    doc = np.searchsorted(begins, starts, side="right") - 1
    pairs, owners = gram_hashes(words, 2), doc[1:]
    pairs[words[1:] == words[:-1]] = REPEATED
    same = owners == doc[:-1]
    again = (words[2:] == words[:-2]) & (doc[2:] == doc[:-2])
    number = np.concatenate((words, pairs[same], np.full(again.sum(), REPEATED, dtype=np.uint64))) & np.uint64((1 << bits) - 1)
    owner = np.concatenate((doc, owners[same], doc[2:][again]))
    order = np.argsort(owner, kind="stable")
    return number[order].astype(np.int64), np.bincount(owner, minlength=len(texts))


def scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    number, counts = features(texts)
    raw = np.full(len(texts), bias)
    full = np.flatnonzero(counts)
    if len(full):  # each text is summed by itself, so that a score depends on nothing else
        begins = (np.cumsum(counts) - counts)[full]
        raw[full] += np.add.reduceat(weights[number], begins) / counts[full] * SCALE
    return 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35)))


def follow_the_leader(rows: list[tuple[np.ndarray, int]], bits: int = BITS) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes over (feature numbers, label)."""
    size = (1 << bits) + 1  # the last is the bias
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(EPOCHS):
        for number, label in rows:
            at, count = np.unique(number, return_counts=True)
            at = np.append(at, size - 1)
            x = np.append(count * (SCALE / max(len(number), 1)), 1.0)
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ x, -35, 35)))
            g = (p - label) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] = ni + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w[:-1], float(w[-1])


def held_out() -> Column:
    """Rows kept from training: the CRC-32 of the id as text, divided by 3, leaves 1; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_trained: int = MAX_TRAINED) -> tuple[np.ndarray, float]:
    """Weights and bias from labelled rows that are not held out; without any, every score is 0.5.

    A label is read where quality is 0 or 1; of a doc_id's several labels the lowest counts.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trained)
    known = known.select(F.col("doc_id").alias("id"), "quality")
    # at most max_trained ids and labels
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select(
        "quality", F.coalesce("text", F.lit("")).cast("binary").alias("text"), "doc_id", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).alias("shard")
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id", "text"])
        labels, made = pdf["quality"].tolist(), []
        for first, texts in chunks(pdf["text"].tolist()):
            number, counts = features(texts)
            made += zip(np.split(number, np.cumsum(counts)[:-1]), labels[first : first + len(texts)], strict=True)
        w, bias = follow_the_leader(made)
        at = np.flatnonzero(w)
        return pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(w[at], bias)})

    rows = rows.withColumn("order", F.xxhash64("doc_id", F.lit("order")))
    found = rows.groupBy("shard").applyInPandas(fit, "feature long, weight double")
    # at most 2 ** BITS features, and the bias
    mean = found.groupBy("feature").agg((F.sum("weight") / SHARDS).alias("weight")).toPandas()
    weights = np.zeros(1 << BITS, dtype=np.float64)
    inner = mean["feature"] >= 0
    weights[mean.loc[inner, "feature"].to_numpy()] = mean.loc[inner, "weight"].to_numpy()
    return weights, float(mean.loc[~inner, "weight"].sum())


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """row (the whole row of docs) and quality_score (0 to 1); a null text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            texts = batch.column("row").field("text").cast(pa.binary())
            # a few hundred texts at a time are copied into Python
            some = (texts.slice(at, 256).to_pylist() for at in range(0, len(texts), 256))
            found = [scores(part, w, b) for held in some for _, part in chunks(held)]
            made = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made)], names=["row", "quality_score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, max_trained: int = MAX_TRAINED) -> DataFrame:
    """row (the whole input row), quality_score, held_out of every row of docs, repeated rows too.

    Labels, language, source and id are no features: a score depends on the text alone, and equal
    texts have equal scores. Null and empty texts have the score that the bias alone gives. Rows
    without a doc_id are scored and never learnt from; of rows that share a labelled doc_id all are
    learnt from with its label. An empty table gives none.
    """
    weights, bias = train(docs.select("doc_id", "text"), labels, max_trained)
    found = score(docs, weights, bias)
    return found.withColumn("held_out", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False)))
