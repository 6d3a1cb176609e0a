"""op10: lines that repeat across documents, removed everywhere but in one.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case.  Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines except in the largest doc_id that
holds them.

1. ``line_hashes``: one row a line, (128-bit key hash, doc_id, position).
2. Range partitioning by (hash, doc_id descending): a line that a third of all
   documents share is dealt over many partitions, in order.  Each is sorted by
   hash, document and position and streamed: the first document of a run is the
   keeper, lines of the third and later documents are dropped at once.  State is
   the current run's first document and the rows of its second one.
3. Only the runs at a partition's two ends may go on in a neighbour; their rows
   are left pending and settled by at most two summary rows a partition.
4. Dropped positions become one compressed keep bitmap a document.

Rows are told apart by (doc_id, text hash): repeats of a whole row get the same
result, rows that share a doc_id but not the text are one document with several
rows.  A null doc_id counts as one document, smaller than all others.  Null or
empty text is one empty line and stays.  Empty tables give empty results; other
columns pass through ``remove_repeated_lines`` untouched, whatever their names.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names, release, row_key, sub_batches, written

WHITE = b" \t\n\r\x0b\x0c"
MIN_CHARS, MIN_DOCS = 20, 3

LINES = "h1 long, h2 long, doc long, tx long, pos int"
MARKS = "kind int, h1 long, h2 long, doc long, tx long, pos int, n_docs long"
DROP, PENDING, SUMMARY = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """bytes.lower and strip touch ASCII only, as the key asks."""
    return line.strip(WHITE).lower()


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for piece in sub_batches(batch, 2):
                hashes, docs, txs, at = [], [], [], []
                texts = piece.column(2).cast(pa.binary()).to_pylist()
                for doc, tx, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), texts, strict=True):
                    if not text:
                        continue
                    for pos, line in enumerate(text.split(b"\n")):
                        if len(line) < min_chars:
                            continue
                        key = line_key(line)
                        # a code point has at most four bytes
                        if len(key) < 4 * min_chars and len(key.decode()) < min_chars:
                            continue
                        hashes.append(digest(key))
                        docs.append(doc)
                        txs.append(tx)
                        at.append(pos)
                h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(docs, pa.int64()),
                     pa.array(txs, pa.int64()), pa.array(at, pa.int32())], names=["h1", "h2", "doc", "tx", "pos"])
        release()
    return run


def _mark_runs(min_docs: int):
    """Stream sorted lines; see step 2 and 3 above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, opening, first, prev, n, held = None, True, None, None, 0, []
        out: list[tuple] = []

        def rows() -> pa.RecordBatch:
            nonlocal out
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              names=["kind", "h1", "h2", "doc", "tx", "pos", "n_docs"])

        for batch in batches:
            for h1, h2, doc, tx, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) != current:
                    if current and opening:
                        out.append((SUMMARY, *current, first, None, None, n))
                        opening = False
                    current, first, prev, n, held = (h1, h2), doc, doc, 1, []
                elif doc != prev:
                    prev = doc
                    n += 1
                    if n == min_docs and not opening:
                        out += [(DROP, h1, h2, *x, None) for x in held]
                        held = []
                if opening:
                    out.append((PENDING, h1, h2, doc, tx, pos, None))
                elif n >= min_docs and n > 1:
                    out.append((DROP, h1, h2, doc, tx, pos, None))
                elif n > 1:
                    held.append((doc, tx, pos))
            if out:
                yield rows()
        if current:
            out += [(PENDING, *current, *x, None) for x in held]
            out.append((SUMMARY, *current, first, None, None, n))
            yield rows()
    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, dropped = [], []
        for positions in batch.column(2).to_pylist():
            keep = np.ones(-(-(max(positions) + 1) // 8) * 8, bool)  # whole bytes: no bits of padding
            keep[positions] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(len(positions))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dropped, pa.int64()),
                                          pa.array(packed, pa.binary())],
                                         names=["__doc", "__tx", "__dropped", "__keep"])


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each document that loses lines: __doc (doc_id), __tx (text
    hash), __dropped (lines lost), __keep (zlib of packed bits, 1 = keep, in line
    order; lines past the last bit stay)."""
    rows = documents.select(*row_key(), F.col("text").cast("string").alias("text"))
    lines = rows.mapInArrow(_hash_lines(min_chars), LINES)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order, "tx", "pos")
    marks = written(ordered.mapInArrow(_mark_runs(min_docs), MARKS), "line-marks")
    # at most two rows a partition
    ends = (marks.where(F.col("kind") == SUMMARY).groupBy("h1", "h2")
            .agg(F.max("doc").alias("keeper"), F.sum("n_docs").alias("n")).where(F.col("n") >= min_docs))
    pending = (marks.where(F.col("kind") == PENDING).join(F.broadcast(ends), ["h1", "h2"])
               .where(~F.col("doc").eqNullSafe(F.col("keeper"))))
    places = ["doc", "tx", "pos"]
    dropped = marks.where(F.col("kind") == DROP).select(*places).unionByName(pending.select(*places))
    return (dropped.groupBy("doc", "tx").agg(F.collect_set("pos").alias("pos"))
            .mapInArrow(_bitmaps, "__doc long, __tx long, __dropped long, __keep binary"))


def kept_mask(n: int, keep: bytes | None) -> np.ndarray:
    mask = np.ones(n, bool)
    if keep:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n].astype(bool)
        mask[:bits.size] = bits
    return mask


def kept_text(text: str, keep: bytes | None) -> tuple[str, int]:
    """The remaining lines joined by line feeds, and the number of lines before."""
    lines = text.split("\n")
    if not keep:
        return text, len(lines)
    mask = kept_mask(len(lines), keep)
    return "\n".join([x for x, k in zip(lines, mask.tolist(), strict=True) if k]), len(lines)


def _with_bitmaps(documents: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    maps = keep_bitmaps(documents, min_chars, min_docs).withColumnsRenamed({"__doc": "__mdoc", "__tx": "__mtx"})
    key_doc, key_tx = row_key()
    keyed = documents.withColumns({"__doc": key_doc, "__tx": key_tx})
    on = keyed["__doc"].eqNullSafe(maps["__mdoc"]) & (keyed["__tx"] == maps["__mtx"])
    return keyed.join(maps, on, "left").drop("__mdoc", "__mtx", "__tx")


def line_dedup_digest(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sub_batches(batch, 1):
                lines, sha = [], []
                for text, keep in zip(piece.column(1).to_pylist(), piece.column(3).to_pylist(), strict=True):
                    kept, n = kept_text(text or "", keep)
                    lines.append(n)
                    sha.append(hashlib.sha256(kept.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(lines, pa.int64()), piece.column(2), pa.array(sha)],
                    names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    joined = _with_bitmaps(documents.select("doc_id", "text"), min_chars, min_docs)
    return (joined.select("__doc", F.col("text").cast("string"), F.coalesce("__dropped", F.lit(0).cast("long")), "__keep")
            .mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"))


def remove_repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``documents`` with the repeated lines gone from ``text``; same columns, same rows."""
    docs, back = own_names(documents)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sub_batches(batch, at, 4 << 20):
                text, keep = piece.column(at), piece.column(len(names))
                cut = pc.and_(text.is_valid(), keep.is_valid())
                kept = [kept_text(t, k)[0] for t, k in zip(text.filter(cut).to_pylist(), keep.filter(cut).to_pylist(), strict=True)]
                columns = piece.columns[:len(names)]
                columns[at] = pc.replace_with_mask(text, cut, pa.array(kept, text.type))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        release()

    joined = _with_bitmaps(docs, min_chars, min_docs).select(*names, "__keep")
    return back(joined.mapInArrow(run, docs.schema))
