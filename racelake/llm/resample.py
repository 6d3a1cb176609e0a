"""op13: importance resampling towards a target distribution, on Arrow kernels.

Both corpora are hashed n-gram bags.  A task lower-cases A-Z (``ascii_lower``), cuts
words (``split_pattern_regex``, ``list_flatten``) and numbers them by
``dictionary_encode``; the numbers shifted by one word and paired form the n-grams, so
a string is only built, and its CRC only computed, once for each distinct n-gram of a
batch.  Everything else is integer arrays: ``take`` looks up buckets and gains, and a
segment sum gives a document's total.

1. Counts per bucket of the corpus and of the target: one array a task, summed by Spark.
2. A bucket's gain is floor(1000 * ln of the smoothed ratio target / corpus).
3. A document's weight is the floored mean gain; Gumbel noise fixed by the seed and the
   doc_id is added, and the highest scores are drawn: sampling without replacement in
   proportion to the weight.  Ranks come from a range sort with prefix sums
   (``operators.rank``), so no task ever sees all scores.

Only the counts and the gains (one row a bucket) pass through the driver.

Results.  Null and empty text, or text without a word: no features, weight 0, never
drawn (it has under ``min_words`` words).  A null doc_id counts as the empty text in the
noise and comes first among equal scores; equal rows get successive ranks.  Texts of any
length are used whole.  An empty target or corpus: its counts are 0, the smoothing
stands.  An empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.operators.rank import global_rank

from .common import release, sub_batches, written

#: Anything that is no letter, digit or character beyond ASCII, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MAX_N = 1
SEED = 2024
MIN_WORDS = 20
DRAW_PERCENT = 10
#: Text bytes of one pass of the kernels: arrays of a few times this size.
PASS_BYTES = 4 << 20


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, numbered, and the text each stands in."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(pc.binary_length(flat), 0)  # a separator at an end leaves an empty piece
    flat, owner = flat.filter(real), owner.filter(real)
    return pc.dictionary_encode(flat), owner.to_numpy(zero_copy_only=False).astype(np.int64)


def features(texts: pa.Array, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every run of 1 to ``max_n`` words, and the words of every text."""
    encoded, owner = words(texts)
    n_words = np.bincount(owner, minlength=len(texts))
    grams = encoded.dictionary.to_pylist()
    index = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary, last_word = grams, index
    found, owners = [], []
    for n in range(1, max_n + 1):
        if n > 1:
            # a run of n words: a run of n - 1 words, and the last word of the run one word on
            same = owner[:-1] == owner[1:]
            pairs = (index[:-1] * len(vocabulary) + last_word[1:])[same]
            distinct, index_new = np.unique(pairs, return_inverse=True)
            grams = [f"{grams[p // len(vocabulary)]} {vocabulary[p % len(vocabulary)]}" for p in distinct.tolist()]
            owner = owner[:-1][same]
            index, last_word = index_new, last_word[1:][same]
        bucket = pa.array(np.array([zlib.crc32(g.encode()) % buckets for g in grams], np.int64))
        found.append(bucket.take(pa.array(index)).to_numpy(zero_copy_only=False))
        owners.append(owner)
    return np.concatenate(found), np.concatenate(owners), n_words


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features of the column ``text`` in each bucket; at most ``buckets`` rows a task and in the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in sub_batches(batch, 0, PASS_BYTES):
                bucket, _, _ = features(piece.column(0), max_n, buckets)
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the smoothed ratio of target to source, for each bucket."""
    size = len(source)
    s_all, t_all = float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(documents: DataFrame, gain: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value)
        for batch in batches:
            for piece in sub_batches(batch, 1, PASS_BYTES):
                bucket, owner, n_words = features(piece.column(1), max_n, len(table))
                gained = table.take(pa.array(bucket)).to_numpy(zero_copy_only=False)
                n = np.bincount(owner, minlength=piece.num_rows)
                order = np.argsort(owner, kind="stable")
                sums = np.concatenate([[0], np.cumsum(gained[order])])
                ends = np.cumsum(n)
                weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n_words), pa.array(n), pa.array(weight)],
                                                 names=["doc_id", "n_words", "n_features", "weight"])
        release()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int = SEED):
    """floor(1000 * Gumbel noise), fixed by the seed and the doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(documents: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, draw_percent: int = DRAW_PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every document.

    Of the N documents with ``min_words`` words or more, floor(``draw_percent`` * N / 100)
    are drawn by highest score; equal scores by the smaller doc_id."""
    gain = gains(bucket_counts(documents, max_n, buckets), bucket_counts(target, max_n, buckets))
    scored = written(weights(documents, gain, max_n).withColumn("score", F.col("weight") + noise(seed)), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * draw_percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = global_rank(scored.where(able).select(*out), [F.desc("score"), F.asc("doc_id")], "rank")
    ranked = ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~able).select(*out, F.lit(None).cast("long").alias("rank")))
