"""op8: exact top-k inner products by norm-bucketed retrieval.

1. Components become integers floor(256 * x).  Vectors are sorted by length and
   cut into buckets of at most ``BUCKET`` rows (many equal vectors just fill
   several buckets).
2. The bucket of the longest vectors (one bounded block) gives every query a
   first threshold: its k-th best product there.
3. A query visits only buckets whose longest vector can still reach that
   threshold: |q| * max|p| >= threshold.  A bucket's rows come first in its
   partition, then stream its queries; many queries split a bucket's work.
4. In a bucket the local cosine threshold (threshold / (|q| * max|p|)) chooses
   the pruning: low ones prune by length alone, high ones also bound each
   candidate's value on the query's largest coordinates.  What remains is
   verified with exact integer products.
5. The k best of a query are taken from its buckets' best.

Rows that are null, hold a null or non-finite component, or have no vec_id take no
part; all others do.  Scaled components and scores beyond plus or minus (2^63 - 1) are
held at that; all others are exact.  Shorter vectors count as
padded with zeros.  A query's own row is left out, other rows with its vec_id
are not; each repeated query row has its own result.  Ties go to the smaller
vec_id.  Fewer candidates than k: all.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE, K, EVERY = 256, 5, 50
BUCKET = 4096
#: Queries that one task meets a bucket with.
QUERY_SPLIT = 50_000
#: Local cosine thresholds from which coordinates prune, and how many of them.
COSINE, FOCUS = 0.3, 3
_SLACK = 1e-9
_LONG = 2**63 - 1


def vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, v, norm) of the rows that take part."""
    top = F.lit(_LONG)
    scaled = F.transform("embedding", lambda x: F.greatest(-top, F.least(top, F.floor(x.cast("double") * scale))))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<long>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v", norm.alias("norm"))


def _bucketed(rows: DataFrame, size: int) -> DataFrame:
    """Add ``bucket``: rows in descending order of length, ``size`` to a bucket."""
    ordered = (rows.repartitionByRange(F.col("norm").desc(), "uid").sortWithinPartitions(F.col("norm").desc(), "uid"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            buckets = base + (n + np.arange(batch.num_rows)) // size
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets)], names=[*batch.schema.names, "bucket"])
    return ordered.mapInArrow(number, "uid long, vec_id long, v array<long>, norm double, bucket long")


def _matrix(lists: list[list[int]], dim: int | None = None) -> np.ndarray:
    dim = max([dim or 0, *map(len, lists)])
    out = np.zeros((len(lists), dim), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def products(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of m with q."""
    dim = min(m.shape[1], q.size)
    m, q = m[:, :dim], q[:dim]
    if not dim or not m.shape[0]:
        return np.zeros(m.shape[0], np.int64)
    top = float(max(-int(m.min()), int(m.max()))) * float(max(-int(q.min()), int(q.max()))) * dim
    if top < 2.0 ** 53:  # doubles hold every partial sum exactly
        return (m.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if top < 2.0 ** 62:
        return m @ q
    exact = m.astype(object) @ q.astype(object)
    return np.array([min(max(int(x), -_LONG), _LONG) for x in exact], np.int64)


class Bucket:
    """Rows of similar length, with what pruning needs."""

    def __init__(self, uids, ids, lists, norms):
        self.uids, self.ids = np.array(uids, np.int64), np.array(ids, np.int64)
        self.m = _matrix(lists)
        self.norms = np.array(norms, np.float64)  # descending
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.nan_to_num(self.m / self.norms[:, None])

    def best(self, uid: int, q: np.ndarray, norm: float, least: float | None, k: int) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best rows whose product reaches ``least``."""
        rows = np.arange(self.ids.size)
        longest = float(self.norms[0]) if self.norms.size else 0.0
        if least is not None and least > 0:
            if norm * longest * (1 + _SLACK) < least:
                return []
            rows = rows[:int(np.searchsorted(-self.norms, -least / norm * (1 - _SLACK), "right"))]
            cosine = least / (norm * longest)
            if cosine >= COSINE:
                # |angle(p, axis) - angle(q, axis)| <= angle(p, q) <= spread
                spread = np.arccos(min(1.0, cosine))
                for f in np.argsort(-np.abs(q))[:FOCUS].tolist():
                    if f >= self.unit.shape[1]:
                        continue
                    angle = np.arccos(np.clip(q[f] / norm, -1, 1))
                    low = np.cos(min(np.pi, angle + spread)) - 1e-7
                    high = np.cos(max(0.0, angle - spread)) + 1e-7
                    own = self.unit[rows, f]
                    rows = rows[(own >= low) & (own <= high)]
        rows = rows[self.uids[rows] != uid]
        scores = products(self.m[rows], q)
        if scores.size > k:
            kth = np.partition(scores, scores.size - k)[scores.size - k]
            near = np.flatnonzero(scores >= kth)
        else:
            near = np.arange(scores.size)
        found = sorted(zip((-scores[near]).tolist(), self.ids[rows[near]].tolist(), strict=True))[:k]
        return [(-s, i) for s, i in found]


def _plan_visits(head: Bucket | None, buckets: np.ndarray, longest: np.ndarray, k: int):
    """Add each query's first threshold and the buckets it must visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, visits = [], []
            for uid, v, norm in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                found = head.best(uid, np.array(v, np.int64), norm, None, k) if head else []
                t = found[k - 1][0] if len(found) == k else None
                least.append(t)
                visits.append(buckets if t is None or t <= 0 else buckets[norm * longest * (1 + _SLACK) >= t])
            ends = np.cumsum([0] + [len(x) for x in visits]).astype(np.int32)
            flat = np.concatenate(visits) if visits else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))],
                names=[*batch.schema.names, "least", "visits"])
    return run


def _search(k: int):
    """Stream one bucket after the other: its rows, then its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, bucket = None, [], None
        for batch in batches:
            quid, qid, vec, score = [], [], [], []
            for key, salt, uid, vec_id, v, norm, asks, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, salt) != current:
                    current, rows, bucket = (key, salt), [], None
                if not asks:
                    rows.append((uid, vec_id, v, norm))
                    continue
                if bucket is None:
                    bucket = Bucket(*zip(*rows, strict=True)) if rows else Bucket([], [], [], [])
                for s, i in bucket.best(uid, np.array(v, np.int64), norm, least, k):
                    quid.append(uid)
                    qid.append(vec_id)
                    vec.append(i)
                    score.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (quid, qid, vec, score)],
                                             names=["uid", "query_id", "vec_id", "score"])
    return run


def top_k(table: DataFrame, k: int = K, every: int = EVERY, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id ``every`` divides."""
    rows = written(_bucketed(written(vectors(table), "vectors"), bucket), "buckets")
    # one number a bucket, for the driver; the first bucket holds the longest vectors
    lengths = sorted((r["bucket"], r["longest"]) for r in rows.groupBy("bucket").agg(F.max("norm").alias("longest")).collect())
    head = None
    if lengths:
        block = rows.where(F.col("bucket") == lengths[0][0]).orderBy(F.col("norm").desc(), "uid").collect()  # at most ``bucket`` rows
        head = Bucket([r["uid"] for r in block], [r["vec_id"] for r in block], [r["v"] for r in block], [r["norm"] for r in block])
    plan = _plan_visits(head, np.array([x for x, _ in lengths], np.int64), np.array([x for _, x in lengths], np.float64), k)
    asking = rows.where(F.pmod("vec_id", F.lit(every)) == 0).drop("bucket")
    asking = written(asking.mapInArrow(plan, "uid long, vec_id long, v array<long>, norm double, least long, visits array<long>"), "queries")
    splits = max(1, -(-asking.count() // QUERY_SPLIT))
    salt = F.pmod(F.xxhash64("uid"), F.lit(splits)).cast("int")
    visits = asking.withColumn("bucket", F.explode("visits"))
    queries = visits.select("bucket", salt.alias("salt"), "uid", "vec_id", "v", "norm",
                            F.lit(True).alias("asks"), "least")
    copies = rows.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("salt"), "uid", "vec_id", "v", "norm",
                         F.lit(False).alias("asks"), F.lit(None).cast("long").alias("least"))
    met = (copies.unionByName(queries).repartition("bucket", "salt")
           .sortWithinPartitions("bucket", "salt", "asks", F.col("norm").desc(), "uid"))
    found = met.mapInArrow(_search(k), "uid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
