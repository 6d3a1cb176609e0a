"""op9: cost-balanced packing of token ids into fixed-length sequences.

The cost of a piece of n tokens is ``linear * n + quadratic * n * n`` (matrix
products and attention).  Every task packs windows of about ``WINDOW_IDS`` ids
of its own input partition: no shuffle, bounded memory, and one hot source or
group of copies is spread like any other rows.  Within a window of T ids there
are ceil(T / length) sequences, so padding is below one sequence a window:

1. whole blocks of ``length`` ids are cut off long documents, a sequence each;
2. the remaining pieces go, longest first, to the sequence with the lowest cost
   among those with room for the whole piece;
3. a piece that fits nowhere whole is cut across the sequences with most room.

Sequence ids: partition number * 2^32 + a number within the partition.
Null text is empty: a piece of the end id alone.  Null and repeated doc_ids are
kept as they are, one set of pieces a row.  Ties (equal lengths, equal cost)
go to the earlier row and the lower sequence number.  An empty table gives no
rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, sub_batches
from .tokenizing import encoder

LENGTH = 4096
#: Ids packed together; bounds a task's memory (4 bytes an id) and the padding.
WINDOW_IDS = 1 << 22
#: Words whose ids a worker remembers, and text bytes encoded at once.
WORDS, TEXT_BYTES = 300_000, 6 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def assign(sizes: np.ndarray, length: int = LENGTH, linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pack documents of the given sizes: (document, start, count, sequence, offset)."""
    total = int(sizes.sum())
    n_seq = -(-total // length)
    room = np.full(n_seq, length, np.int64)
    cost = np.zeros(n_seq)
    fill = np.zeros(n_seq, np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    rest = []
    seq = 0
    for doc, size in enumerate(sizes.tolist()):
        at = 0
        while size - at >= length:
            out.append((doc, at, length, seq, 0))
            room[seq] = 0
            seq += 1
            at += length
        if size > at:
            rest.append((size - at, doc, at))
    rest.sort(key=lambda x: (-x[0], x[1]))
    full = seq  # sequences below this number are full
    room, cost, fill = room[full:], cost[full:], fill[full:]

    def put(j: int, doc: int, at: int, n: int) -> None:
        out.append((doc, at, n, full + j, int(fill[j])))
        fill[j] += n
        room[j] -= n
        cost[j] += linear * n + quadratic * n * n

    for n, doc, at in rest:
        j = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[j] >= n:
            put(j, doc, at, n)
            continue
        while n:
            j = int(np.argmax(room))
            take = min(n, int(room[j]))
            put(j, doc, at, take)
            at, n = at + take, n - take
    return out


def pack_function(vocab: str, end_id: int, length: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, base = encoder(vocab, WORDS).encode_many, TaskContext.get().partitionId() << 32
        docs, ids, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, ids, held, base
            sizes = np.array([len(x) >> 2 for x in ids], np.int64)
            pieces = assign(sizes, length)
            doc, start, count, seq, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            crc = [zlib.crc32(ids[d][4 * a:4 * (a + n)]) for d, a, n, _, _ in pieces]
            taken = pa.array(docs, pa.int64()).take(pa.array(doc))
            out = pa.RecordBatch.from_arrays([
                taken, pa.array(start), pa.array(count), pa.array(crc, pa.int64()), pa.array(sizes[doc]),
                pa.array(base + seq), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            base += -(-int(sizes.sum()) // length)
            docs, ids, held = [], [], 0
            return out

        for batch in batches:
            for piece in sub_batches(batch, 1, TEXT_BYTES):
                flat, counts = encode(piece.column(1), end_id)
                data, at = flat.tobytes(), 0
                for doc, n in zip(piece.column(0).to_pylist(), counts.tolist(), strict=True):
                    docs.append(doc)
                    ids.append(data[at:at + 4 * n])
                    at += 4 * n
                    held += n
                    if held >= window:
                        yield flush()
        if docs:
            yield flush()
        release()
    return run


def pack_documents(documents: DataFrame, vocab: str, end_id: int = 2, length: int = LENGTH,
                   window: int = WINDOW_IDS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack_function(vocab, end_id, length, window), PIECES)
