"""op6: language identification by prediction by partial matching (PPM).

For each language a variable-order tree of byte contexts (0 to ``ORDER`` bytes)
is counted on labelled rows, then frozen.  A context with n observations of t
distinct bytes gives byte s the probability count / (n + t) and the escape
t / (n + t); an escape goes on in the next shorter context, at last to one in
256.  A text's code length in a language is the exact sum over all its bytes,
and the shortest code wins (ties: the smaller name).  ``score`` is the
winner's share when every language is equally likely beforehand.

A tree is kept sparse: for each order, the sorted codes of its (context, byte) pairs with
their code lengths, and the sorted codes of its contexts with the cost of their escapes.
Trees are counted by Spark and frozen one language at a time, every context of every
language kept, so no language is cut by the others and a model of many languages is as
large as its trees.  A byte's cost depends on it and the ``ORDER`` bytes before alone, so a
task looks up each distinct code of a chunk once and remembers it for the next chunks.

Bound of the classifier: about ``SAMPLE_ROWS`` labelled rows a language (all, if there are
fewer), taken by a hash of the row.  Everything else covers all rows and whole texts.

Null text, empty text and text without a letter: ``und``, score 0; so is all
if nothing could be learned.  Repeated rows are predicted alike.  Null doc_ids
are neither held out nor learned from.  Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sub_batches, written

ORDER = 3
SAMPLE_ROWS = 4000
#: Numbers (codes x languages) that a task works on at once, and that it remembers
#: before it starts afresh; with more languages it takes fewer bytes at once.
CHUNK = 1 << 21
REMEMBERED = 1 << 22

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    # the pattern also finds numerals that are not decimal digits
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def held_out(doc_id: str = "doc_id"):
    """Rows whose crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of ORDER + 1 successive bytes by language; zero bytes stand before a text."""
    sums: dict[str, dict[int, int]] = {}
    for batch in batches:
        for piece in sub_batches(batch, 1, 1 << 20):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).cast(pa.binary()).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                data = np.frombuffer(bytes(ORDER) + bytes(ORDER).join(texts), np.uint8).astype(np.uint32)
                codes = data[:-ORDER].copy()
                for k in range(1, ORDER + 1):
                    codes = (codes << np.uint32(8)) | data[k:data.size - ORDER + k]
                values, counts = np.unique(codes, return_counts=True)
                into = sums.setdefault(lang, {})
                for v, c in zip(values.tolist(), counts.tolist(), strict=True):
                    if v & 255:  # not the zero bytes between texts
                        into[v] = into.get(v, 0) + c
    for lang, counts in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts)), pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["lang", "code", "n"])


def train(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Frozen trees of all languages of ``documents`` (text, lang, doc_id)."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(~held_out()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return {"langs": [], "trees": []}
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, min(1.0, sample_rows / n)).otherwise(rate)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    grams = written(rows.where(place < rate).select("lang", "text").mapInArrow(_grams, "lang string, code long, n long")
                    .groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")
    langs = sorted(sizes)
    # one language at a time: the driver holds the counts of one and the trees so far
    return {"langs": langs, "trees": [freeze(grams.where(F.col("lang") == x).select("code", "n").toArrow()) for x in langs]}


def freeze(grams: pa.Table) -> dict:
    """One language's tree from its counts (code, n) of ORDER + 1 successive bytes.

    ``pairs`` and ``contexts`` hold (sorted codes, bits) for each order: bits of the
    byte in that context, and bits of an escape from it."""
    code = grams.column("code").to_numpy().astype(np.uint32)
    count = grams.column("n").to_numpy().astype(np.float64)
    pairs, contexts = [], []
    for order in range(ORDER + 1):
        # a zero byte in the context means that it would reach over the text's start
        whole = np.ones(code.size, bool)
        for k in range(1, order + 1):
            whole &= (code >> np.uint32(8 * k)) & np.uint32(255) > 0
        pair, place = np.unique(code[whole] & _mask(order + 1), return_inverse=True)
        freq = np.bincount(place, weights=count[whole], minlength=pair.size)
        context, owner, t = np.unique(pair >> np.uint32(8), return_inverse=True, return_counts=True)
        n = np.bincount(owner, weights=freq, minlength=context.size)
        pairs.append((pair, -np.log2(freq / (n + t)[owner]).astype(np.float32)))
        contexts.append((context, -np.log2(t / (n + t)).astype(np.float32)))
    return {"pairs": pairs, "contexts": contexts}


def _mask(n_bytes: int) -> np.uint32:
    return np.uint32((1 << 8 * n_bytes) - 1)


def _find(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, bits) of ``codes`` in a table of sorted codes."""
    held, bits = table
    if not held.size:
        return np.zeros(codes.size, bool), np.zeros(codes.size)
    at = np.minimum(np.searchsorted(held, codes), held.size - 1)
    return held[at] == codes, bits[at]


def tree_bits(tree: dict, codes: np.ndarray) -> np.ndarray:
    """Bits of the last byte of every code after the bytes before it."""
    bits, live = np.zeros(codes.size), np.ones(codes.size, bool)
    for order in range(ORDER, -1, -1):
        there = live.copy()
        for k in range(1, order + 1):
            there &= (codes >> np.uint32(8 * k)) & np.uint32(255) > 0
        rows = np.flatnonzero(there)
        short = codes[rows] & _mask(order + 1)
        hit, own = _find(tree["pairs"][order], short)
        bits[rows[hit]] += own[hit]
        live[rows[hit]] = False
        rows, short = rows[~hit], short[~hit] >> np.uint32(8)
        held, escape = _find(tree["contexts"][order], short)
        bits[rows[held]] += escape[held]
    return bits + 8.0 * live


class Scorer:
    """Code lengths in all languages; remembers the codes it has met."""

    def __init__(self, model: dict):
        self.trees = model["trees"]
        self.chunk, self.limit = [max(1 << 12, x // max(len(self.trees), 1)) for x in (CHUNK, REMEMBERED)]
        self._forget()

    def _forget(self) -> None:
        self.codes, self.bits = np.zeros(0, np.uint32), np.zeros((0, len(self.trees)))

    def _rows(self, distinct: np.ndarray) -> np.ndarray:
        """Bits of sorted distinct codes: (codes, languages)."""
        if self.codes.size + distinct.size > self.limit:
            self._forget()
        at = np.searchsorted(self.codes, distinct)
        known = np.zeros(distinct.size, bool)
        inside = at < self.codes.size
        known[inside] = self.codes[at[inside]] == distinct[inside]
        new = distinct[~known]
        if new.size:
            fresh = np.stack([tree_bits(t, new) for t in self.trees], 1)
            self.codes, self.bits = np.insert(self.codes, at[~known], new), np.insert(self.bits, at[~known], fresh, 0)
            at = np.searchsorted(self.codes, distinct)
        return self.bits[at]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of every text in every language: (texts, languages)."""
        out = np.zeros((len(texts), len(self.trees)))
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum() or not self.trees:
            return out
        # zero bytes before each text: no context reaches over its start
        data = np.frombuffer(bytes(ORDER) + bytes(ORDER).join(texts), np.uint8)
        owner = np.repeat(np.arange(len(texts)), sizes)
        for lo in range(0, owner.size, self.chunk):
            who = owner[lo:lo + self.chunk]
            at = np.arange(lo, lo + who.size) + ORDER * (who + 1)
            codes = np.zeros(who.size, np.uint32)
            for k in range(ORDER, -1, -1):
                codes = (codes << np.uint32(8)) | data[at - k]
            distinct, place = np.unique(codes, return_inverse=True)
            bits = self._rows(distinct)
            low = int(who[0])
            span = int(who[-1]) - low + 1
            for lang in range(len(self.trees)):
                out[low:low + span, lang] += np.bincount(who - low, bits[:, lang][place], span)
        return out


def predict(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; reads the text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, scorer = shared.value["langs"], Scorer(shared.value)
        for batch in batches:
            for piece in sub_batches(batch, 2, 2 << 20):
                texts = piece.column(2).to_pylist()
                lettered = np.array([bool(t) and has_letter(t) for t in texts], bool)
                names, scores = ["und"] * len(texts), np.zeros(len(texts))
                if langs:
                    raw = [t or b"" for t in piece.column(2).cast(pa.binary()).to_pylist()]
                    bits = scorer.code_lengths(raw)
                    best = bits.argmin(1)
                    share = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
                    names = [langs[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
                    scores = np.where(lettered, share, 0.0)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(names), pa.array(scores)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    return predict(documents, train(documents, sample_rows))
