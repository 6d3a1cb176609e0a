"""op1: token ids of all documents in a block file, in ascending doc_id order.

``write_token_file`` range-partitions the texts by doc_id, encodes each
partition in order and writes blocks of whole documents.  A block is a Parquet
row: document ids and lengths, Simple-8b words, escapes and word offsets
(``simple8b``).  Parquet is only the container: its commit protocol makes the
file safe against lost or repeated tasks on any store.

Order and ties: (doc_id, hash of the text, arrival).  The third column keeps a
hot doc_id (for instance null for a third of the rows) splittable.  Null
doc_ids come first.  Null text: empty, so its document is the end id alone.
An empty table gives an empty file.  A text of any length is encoded whole; a
block always holds whole documents, so one very long document is one block.
Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simple8b
from .common import fresh_path, sub_batches
from .tokenizing import encoder

#: Ids after which a block is closed (at a document's end).
BLOCK_IDS = 1 << 16

BLOCKS = ("part int, block int, part_start long, n_ids long, doc_ids array<long>, lengths array<int>, "
          "words binary, escapes binary, offsets binary")
ROWS = "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long"


def encode_blocks(vocab: str, end_id: int | None):
    """mapInArrow function: (doc_id, text) rows in order -> block rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, part = encoder(vocab).encode_many, TaskContext.get().partitionId()
        start, number = 0, 0
        docs, lengths, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal start, number, docs, lengths, parts, held
            ids = np.concatenate(parts)
            words, escapes, offsets = simple8b.encode(ids)
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()),
                pa.array([ids.size], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())), pa.array([words], pa.binary()),
                pa.array([escapes], pa.binary()), pa.array([offsets], pa.binary())],
                names=["part", "block", "part_start", "n_ids", "doc_ids", "lengths", "words", "escapes", "offsets"])
            start, number = start + ids.size, number + 1
            docs, lengths, parts, held = [], [], [], 0
            return out

        for batch in batches:
            for piece in sub_batches(batch, 1):
                ids, counts = encode(piece.column(1), end_id)
                at = 0
                for doc, n in zip(piece.column(0).to_pylist(), counts.tolist(), strict=True):
                    docs.append(doc)
                    lengths.append(n)
                    parts.append(ids[at:at + n])
                    at += n
                    held += n
                    if held >= BLOCK_IDS:
                        yield block()
        if docs:
            yield block()
    return run


def write_token_file(documents: DataFrame, path: str, vocab: str, end_id: int | None = 0) -> None:
    """Write the ids of all ``documents`` (doc_id, text) to ``path``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = (rows.withColumn("h", F.xxhash64("text")).withColumn("n", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
               .select("doc_id", "text"))
    # the packed words are dense already; zstd still finds repeated passages
    ordered.mapInArrow(encode_blocks(vocab, end_id), BLOCKS).write.option("compression", "zstd").parquet(path)


def _decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(row["words"], row["escapes"], row["n_ids"]).astype("<u4").tobytes()
            ends = np.cumsum(row["lengths"], dtype=np.int64)
            starts = ends - row["lengths"]
            crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts + row["part_start"], pa.int64()), pa.array(ends - starts, pa.int64()),
                pa.array(crc, pa.int64())], names=["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])


def read_token_file(spark, path: str) -> DataFrame:
    """Per document of the file, from its decoded ids: doc_id, start, n_tokens,
    ids_crc32 (unsigned crc32 of the ids as little-endian uint32)."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # a row per partition of the file: their number, not the data, bounds this
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in sums):
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "part int, before long")
    return (blocks.mapInArrow(_decode_rows, ROWS).join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def decode_documents(spark, path: str) -> DataFrame:
    """doc_id, ids (array<long>) of every document of a token file."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["words"], row["escapes"], row["n_ids"]).astype(np.int64)
                ends = np.cumsum([0, *row["lengths"]], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names=["doc_id", "ids"])
    return spark.read.schema(BLOCKS).parquet(path).mapInArrow(run, "doc_id long, ids array<long>")


def token_output(documents: DataFrame, vocab: str, end_id: int | None = 0) -> DataFrame:
    """Encode to a file in the shared folder and read it back per document."""
    spark = documents.sparkSession
    path = fresh_path(spark, "tokens")
    write_token_file(documents, path, vocab, end_id)
    return read_token_file(spark, path)
