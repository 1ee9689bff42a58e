"""Exact top-k search by inner product (operator 11): pivot-table elimination.

A vector's components become integers, floor(256 * x), so scores are exact. Every vector's distances
to 32 pivots are kept beside it. For a query q and a vector x the largest |d(q, p) - d(x, p)| over the
pivots p is a lower bound b of d(q, x), hence (|q|^2 + |x|^2 - b^2) / 2 an upper bound of their inner
product. Vectors are evaluated in the order of that bound until it falls below the k-th best score.

Rows with one vector are one class of which the k + 1 smallest ids are kept: no result can need more, so
neither a vector nor a query that a third of all rows hold is met more than once. Classes lie in
buckets (nearest pivot, near or far from it), 64 whatever the input, each known by the least and largest
distance to every pivot. A query first searches the bucket with the highest bound; its k-th score there
then rules out whole buckets, and the rest are searched in blocks of bounded size, dealt by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import salted_join, stored

SCALE = 256
K = 5
#: Pivots are taken from the SAMPLE vectors with the smallest hashes, each the farthest from those before it.
PIVOTS = 32
SAMPLE = 2048
#: About how many classes, and how many queries, one task compares.
BLOCK = 8192
QUERIES = 2048
#: Bounds are floats: this share of a bound's size is added so that rounding never rules a vector out.
SLACK = 1e-9


def largest(dim: int) -> int:
    """Scaled components are below this, so that a sum of dim products fits a long."""
    return 2 ** ((62 - max(dim, 1).bit_length()) // 2)


def packed(rows: DataFrame, dim: int) -> DataFrame:
    """vec_id, asked and vec: the scaled components as 32-bit integers, padded by zeros to dim; rows that take no part are left out."""
    limit = min(largest(dim), 2**31)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("embedding").is_valid())
            lists = batch.column("embedding")
            values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))  # a null is not a number
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            spot = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
            fits = np.abs(values) < limit
            out = np.zeros((len(size), dim), dtype=np.int32)
            out[row, spot] = np.where(fits, values, 0).astype(np.int32)
            keep = np.flatnonzero(np.bincount(row, weights=~fits, minlength=len(size)) == 0)
            kept = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("asked"), pa.array([out[i].tobytes() for i in keep], pa.binary())], names=["vec_id", "asked", "vec"])

    return rows.select("vec_id", "asked", "embedding").mapInArrow(run, "vec_id long, asked boolean, vec binary")


def unpacked(column: pa.Array | pd.Series, kind: type) -> np.ndarray:
    """The rows of a binary column as a matrix."""
    cells = column.to_pylist() if isinstance(column, pa.Array) else column.tolist()
    return np.frombuffer(b"".join(cells), dtype=kind).reshape(len(cells), -1)


def farthest_first(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the vectors, each the farthest from all taken before it; the first row is the first."""
    taken = vectors[:1]
    near = ((vectors - taken[0]) ** 2).sum(axis=1)
    while len(taken) < n and near.max() > 0:
        taken = np.vstack([taken, vectors[near.argmax()]])
        near = np.minimum(near, ((vectors - taken[-1]) ** 2).sum(axis=1))
    return taken


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of every vector to every pivot."""
    x = vectors.astype(np.float64)
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots.astype(np.float64)], axis=1)


def indexed(classes: DataFrame, pivots: np.ndarray, middle: np.ndarray) -> DataFrame:
    """classes (vec, members, asked) with norm (|x|^2), dist (its distances) and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unpacked(batch.column(0), np.int32).astype(np.int64)
                dist = distances(x, pivots)
                cell = dist.argmin(axis=1)
                bucket = 2 * cell + (dist[np.arange(len(x)), cell] > middle[cell])
                extra = [pa.array((x * x).sum(axis=1)), pa.array([d.tobytes() for d in dist], pa.binary()), pa.array(bucket.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "norm", "dist", "bucket"])

    return classes.mapInArrow(run, "vec binary, members array<struct<last:boolean,vec_id:long,uid:long>>, asked long, norm long, dist binary, bucket int")


class Buckets:
    """What is known of every bucket: its rows, their largest norm, least and largest distance to every pivot. Two rows a pivot, whatever the input."""

    def __init__(self, index: DataFrame, pivots: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, norm = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                dist = unpacked(batch.column(2), np.float64) if batch.num_rows else None
                for b in np.unique(at):
                    of = at == b
                    lo, hi = dist[of].min(axis=0), dist[of].max(axis=0)
                    n = np.full(len(lo), of.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.full(len(lo), b), np.arange(len(lo)), n, np.full(len(lo), norm[of].max()), lo, hi)], names=["bucket", "pivot", "n", "norm", "lo", "hi"])

        found = index.select("bucket", "norm", "dist").mapInArrow(run, "bucket int, pivot long, n long, norm long, lo double, hi double")
        rows = found.groupBy("bucket", "pivot").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
        self.n, self.norm = np.zeros(2 * pivots, dtype=np.int64), np.zeros(2 * pivots)
        self.lo, self.hi = np.zeros((2 * pivots, pivots)), np.zeros((2 * pivots, pivots))
        for r in rows:
            self.n[r.bucket], self.norm[r.bucket], self.lo[r.bucket, r.pivot], self.hi[r.bucket, r.pivot] = r.n, r.norm, r.lo, r.hi

    def bounds(self, dist: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of queries (rows) with what buckets (columns) hold; -inf where a bucket is empty."""
        least = np.zeros((len(dist), len(self.n)))
        for p in range(self.lo.shape[1]):
            d = dist[:, p : p + 1]
            np.maximum(least, np.maximum(self.lo[:, p] - d, d - self.hi[:, p]), out=least)
        return np.where(self.n > 0, upper(norm[:, None], self.norm, least), -np.inf)


def upper(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Upper bound of an inner product from squared norms and the least distance."""
    return (a + b - least * least) / 2 + SLACK * (a + b) + SLACK


FOUND = "vec binary, score long, last boolean, vec_id long, uid long"


def search(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The rows of classes that can be among a query's k best, evaluated in the order of bounds until none can follow."""
    out: list[tuple] = []
    if len(rows) and len(queries):
        x, dist, norm = unpacked(rows["vec"], np.int32), unpacked(rows["dist"], np.float64), rows["norm"].to_numpy().astype(np.float64)
        q, qdist, qnorm = unpacked(queries["vec"], np.int32), unpacked(queries["dist"], np.float64), queries["norm"].to_numpy().astype(np.float64)
        # sums of products below 2^53 are exact as floats too
        exact = x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2**53
        x, q = (x.astype(np.float64), q.astype(np.float64)) if exact else (x.astype(np.int64), q.astype(np.int64))
        for j, (vec, least) in enumerate(zip(queries["vec"], queries["least"].to_numpy(), strict=True)):
            bound = upper(qnorm[j], norm, np.abs(dist - qdist[j]).max(axis=1))
            order = np.flatnonzero(bound >= least)
            order = order[np.argsort(-bound[order])]
            ids, scores, at, step = order[:0], q[:0, 0], 0, 64
            while at < len(order) and bound[order[at]] >= least:
                taken = order[at : at + step]
                ids, scores = np.concatenate([ids, taken]), np.concatenate([scores, x[taken] @ q[j]])
                if len(scores) >= k:
                    least = max(least, np.partition(scores, len(scores) - k)[len(scores) - k])
                    ids, scores = ids[scores >= least], scores[scores >= least]
                at, step = at + step, 2 * step
            held = [(-int(s), m["last"], m["vec_id"] or 0, m["uid"], m["vec_id"]) for i, s in zip(ids, scores, strict=True) if s >= least for m in rows["members"].iat[i]]
            out += [(vec, -s, last, vec_id, uid) for s, last, _, uid, vec_id in sorted(held, key=lambda r: r[:4])[:k]]
    found = pd.DataFrame(out, columns=["vec", "score", "last", "vec_id", "uid"])
    return found.astype({"score": "int64", "last": "bool", "vec_id": "Int64", "uid": "int64"})


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every vec of found; Spark drops the others before it shuffles."""
    order = Window.partitionBy("vec").orderBy(F.desc("score"), "last", "vec_id", "uid")
    return found.withColumn("r_", F.row_number().over(order)).filter(F.col("r_") <= k).drop("r_")


def searched(index: DataFrame, asked: DataFrame, buckets: Buckets, k: int) -> DataFrame:
    """FOUND for asked: vec, norm, dist, least, and at, an array of (bucket, salt); salt null: all blocks of the bucket but number `seen`."""
    salts = F.array(*[F.lit(max(1, math.ceil(n / BLOCK))) for n in buckets.n.tolist()])
    each = F.when(F.col("to.salt").isNotNull(), F.array("to.salt")).otherwise(F.sequence(F.lit(0), F.get(salts, F.col("to.bucket")) - 1))
    asked = asked.withColumn("to", F.explode("at")).drop("at")
    counts = {r.bucket: r.n for r in asked.groupBy(F.col("to.bucket").alias("bucket")).agg(F.count("*").alias("n")).collect()}  # a row per bucket
    dealt = F.array(*[F.lit(math.ceil(counts.get(b, 0) / QUERIES)) for b in range(len(buckets.n))])
    turn = lambda n: F.pmod(F.xxhash64("vec"), F.greatest(n, F.lit(1))).cast("int")
    asked = asked.withColumn("turn", turn(F.get(dealt, F.col("to.bucket")))).withColumn("salt", F.explode(each))
    asked = asked.filter(~F.col("to.seen").eqNullSafe(F.col("salt"))).select("vec", "norm", "dist", "least", F.col("to.bucket").alias("bucket"), "salt", "turn")
    rows = index.withColumn("salt", turn(F.get(salts, F.col("bucket")))).filter(F.get(dealt, F.col("bucket")) > 0)
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.get(dealt, F.col("bucket")) - 1))).select("vec", "norm", "dist", "members", "bucket", "salt", "turn")
    by = ["bucket", "salt", "turn"]
    return rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(lambda a, b: search(a, b, k), FOUND)


AT = "array<struct<bucket:int,salt:int,seen:int>>"


def homes(asked: DataFrame, buckets: Buckets, k: int) -> DataFrame:
    """asked with at: one block of the bucket with the highest bound among those with k rows or more, if any; least is -inf."""
    blocks = np.maximum(1, -(-buckets.n // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bound = buckets.bounds(unpacked(batch.column("dist"), np.float64), batch.column("norm").to_numpy().astype(np.float64))
                bound[:, buckets.n < k * blocks] = -np.inf
                pick = bound.argmax(axis=1)
                known = np.isfinite(bound.max(axis=1))
                at = [[(int(b), int(s), None)] if ok else [] for b, s, ok in zip(pick, batch.column("salt").to_numpy() % blocks[pick], known, strict=True)]
                cells = [[{"bucket": b, "salt": s, "seen": None} for b, s, _ in x] for x in at]
                kind = pa.list_(pa.struct([("bucket", pa.int32()), ("salt", pa.int32()), ("seen", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec", "norm", "dist")), pa.array(np.full(batch.num_rows, -np.inf)), pa.array(cells, kind)], names=["vec", "norm", "dist", "least", "at"])

    return asked.withColumn("salt", F.pmod(F.xxhash64("dist"), F.lit(2**31 - 1))).mapInArrow(run, f"vec binary, norm long, dist binary, least double, at {AT}")


def rest(asked: DataFrame, buckets: Buckets) -> DataFrame:
    """asked (with least, the k-th score so far, and home, the block that was searched) with at: every bucket whose bound isn't below least."""
    blocks = np.maximum(1, -(-buckets.n // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bound = buckets.bounds(unpacked(batch.column("dist"), np.float64), batch.column("norm").to_numpy().astype(np.float64))
                least = batch.column("least").to_numpy()
                cells = []
                for row, low, home in zip(bound, least, batch.column("home").to_pylist(), strict=True):
                    seen = {h["bucket"]: h["salt"] for h in home}
                    kept = [int(b) for b in np.flatnonzero((row >= low) & np.isfinite(row)) if not (b in seen and blocks[b] == 1)]
                    cells.append([{"bucket": b, "salt": None, "seen": seen.get(b)} for b in kept])
                kind = pa.list_(pa.struct([("bucket", pa.int32()), ("salt", pa.int32()), ("seen", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec", "norm", "dist", "least")), pa.array(cells, kind)], names=["vec", "norm", "dist", "least", "at"])

    return asked.mapInArrow(run, f"vec binary, norm long, dist binary, least double, at {AT}")


def top_k(rows: DataFrame, asked: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that `asked` is true for, the k other rows with the highest inner products.

    rows: vec_id long, embedding an array of numbers; other columns are not read. Ties go to the smaller
    vec_id, a null one last. Rows that repeat an id are rows of their own, each other's results too. Vectors
    that are null, or hold a null, infinite or not a number, or a component whose sum of squares would pass
    a long (2^27 after scaling at 64 components), take no part. Shorter vectors count as padded by zeros.
    With fewer other rows than k all are returned; an empty table gives no rows.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(asked, F.lit(False)).alias("asked"))
    dim = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    # a row's number must not change once given, so it is written
    kept = stored(packed(rows, max(dim, 1)).withColumn("uid", F.monotonically_increasing_id()))
    pivots, middle = _pivots(kept)
    if not len(pivots):
        return kept.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).filter("false")
    few = Window.partitionBy("vec").orderBy("last", "vec_id", "uid")
    ranked = kept.select("vec", F.col("vec_id").isNull().alias("last"), "vec_id", "uid").withColumn("r_", F.row_number().over(few)).filter(F.col("r_") <= k + 1)
    members = ranked.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("last", "vec_id", "uid"))).alias("members"))
    times = kept.filter("asked").groupBy("vec").agg(F.count("*").alias("asked"))
    index = stored(indexed(members.join(times, "vec", "left").select("vec", "members", "asked"), pivots, middle))
    buckets = Buckets(index, len(pivots))
    queries = index.filter("asked is not null").select("vec", "norm", "dist")
    first = stored(homes(queries, buckets, k + 1))
    near = stored(searched(index, first, buckets, k + 1))
    # the score of the last of k + 1, as one of them may be the query's own row
    floor = near.groupBy("vec").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("low"))
    known = first.join(floor, "vec", "left").select("vec", "norm", "dist", F.when(F.col("n") > k, F.col("low")).otherwise(F.lit(float("-inf"))).alias("least"), F.col("at").alias("home"))
    far = searched(index, stored(rest(known, buckets)), buckets, k + 1)
    top = best(near.unionByName(far), k + 1).groupBy("vec").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "last", "vec_id", "uid"))).alias("top"))
    results = stored(top.join(index.filter("asked is not null").select("vec", F.col("asked").alias("n")), "vec"))
    found = salted_join(kept.filter("asked").select("vec_id", "uid", "vec"), results, ["vec"], ["uid"])
    others = F.slice(F.filter("top", lambda x: x["uid"] != F.col("uid")), 1, k)
    found = found.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("r", "x"))
    return found.select("query_id", (F.col("r") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.down")).alias("score"))


def _pivots(kept: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The pivots, and of each the middle distance of the sample's vectors nearest to it; of at most SAMPLE vectors."""
    sample = [r.vec for r in kept.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()]
    if not sample:
        return np.zeros((0, 1)), np.zeros(0)
    vectors = np.unique(np.frombuffer(b"".join(sample), dtype=np.int32).reshape(len(sample), -1), axis=0).astype(np.float64)
    pivots = farthest_first(vectors, PIVOTS)
    dist = distances(vectors, pivots)
    cell = dist.argmin(axis=1)
    return pivots, np.array([np.median(dist[cell == p, p]) for p in range(len(pivots))])


#: For vectors of one length, as list_inner_product asks for.
ORACLE = """
with e as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, e.vec_id, cast(list_inner_product(q.v, e.v) as bigint) as score from e q join e on q.vec_id % 50 = 0 and q.vec_id <> e.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""
