"""op3: BPE encoding and decoding through a transducer lexicon.

1. Words of all documents are counted (each task drops words that it saw less
   than ``MIN_IN_TASK`` times; the lexicon only needs frequent ones), and the
   most frequent, at most ``LEXICON`` of them, go to the driver.
2. Their ids are compiled into a minimal acyclic transducer
   (``transducer``), written once to the shared folder; every executor fetches
   the file and its workers map it into memory.
3. Encoding looks all words up in the automaton and merges only unseen ones,
   pair by pair in rank order; the few words that need the vocabulary's full
   normaliser (beyond Latin-1 letters, digits and ASCII punctuation) go through
   the library.  Which words are in the lexicon never changes a result.
4. Decoding joins the token strings with spaces, as the library does for a
   vocabulary without a decoder.

A word is a run between ASCII white space, which this vocabulary drops.  Null
text is empty: no ids, empty decoded text.  Repeated rows and null doc_ids are
rows like others; an empty table gives no rows (the lexicon is then empty).
Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, store_bytes, sub_batches, written
from .tokenizing import _PLAIN, _WORD_PIECES, byte_level, cut_more, encoder, gather
from .transducer import Transducer, build, to_bytes

LEXICON = 300_000
MIN_IN_TASK = 3
#: Merged words that a worker process remembers (first seen stay).
REMEMBERED = 200_000
#: Words that a counting task holds before it drops those seen once.
COUNTED_WORDS = 1_000_000


class Merger:
    """Exact BPE of a word with the pairs of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = self.vocab[a], self.vocab[b]
            self.pairs[ids] = (rank, self.vocab[a + b])

    def ids(self, piece: str) -> list[int]:
        """``piece``: one pre-tokenized word in the byte-level alphabet."""
        parts = [self.vocab[c] for c in piece[:-1]]
        parts.append(self.vocab[piece[-1] + self.suffix])
        pairs = self.pairs
        while len(parts) > 1:
            best, at = None, -1
            for i, pair in enumerate(zip(parts, parts[1:])):  # noqa: B905
                found = pairs.get(pair)
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            parts[at:at + 2] = [best[1]]
        return parts


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, vocab: str, automaton: str | None):
        self.library = encoder(vocab)
        self.merger = Merger(vocab)
        self.lexicon = Transducer.open(automaton) if automaton else None
        names = self.library.tok.get_vocab(with_added_tokens=True)
        self.tokens = [""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.tokens[i] = token
        self.digits = [str(i) for i in range(len(self.tokens))]
        self.merged: dict[str, list[int]] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of a word that the lexicon doesn't hold."""
        if word.isascii() and word.isalpha():
            return self.merger.ids(word.lower())
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self.library.tok.encode(word, add_special_tokens=False).ids
        out = []
        for piece in _WORD_PIECES.findall(word.lower()):
            out += self.merger.ids(byte_level(piece))
        return out

    def recall(self, word: str) -> list[int]:
        ids = self.merged.get(word)
        if ids is None:
            ids = self.merge(word)
            if len(self.merged) < REMEMBERED:
                self.merged[word] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        lists = pc.ascii_split_whitespace(cut_more(pc.fill_null(texts, ""), ""))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = lists.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        n = len(words)
        sizes, starts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        lexicon_ids = np.zeros(0, np.uint32)
        unseen = np.arange(n)
        if self.lexicon is not None and n:
            offsets, data = _buffers(words)
            place = self.lexicon.places(data, offsets[:-1], offsets[1:])
            known = np.flatnonzero(place >= 0)
            ends = self.lexicon.id_ends
            starts[known] = ends[place[known]]
            sizes[known] = ends[place[known] + 1] - starts[known]
            unseen = np.flatnonzero(place < 0)
            lexicon_ids = self.lexicon.ids
        merged = [self.recall(w) if w else [] for w in words.take(pa.array(unseen)).to_pylist()]
        counts = np.fromiter(map(len, merged), np.int64, len(merged))
        own = np.fromiter((x for m in merged for x in m), np.uint32, int(counts.sum()))
        sizes[unseen] = counts
        starts[unseen] = lexicon_ids.size + np.cumsum(counts) - counts
        pool = np.concatenate((lexicon_ids, own))
        return gather(pool, starts, sizes, index, bounds)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if pa.types.is_large_string(words.type):
        words = words.cast(pa.string())
    _, offsets, data = words.buffers()
    offs = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    return offs, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


_CODECS: dict[tuple, Codec] = {}


def codec(vocab: str, file: str | None) -> Codec:
    """One codec per worker process; the last automaton stays open."""
    if (vocab, file) not in _CODECS:
        from pyspark import SparkFiles
        _CODECS.clear()
        _CODECS[vocab, file] = Codec(vocab, SparkFiles.get(file) if file else None)
    return _CODECS[vocab, file]


def _count_words(min_in_task: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for piece in sub_batches(batch, 0):
                found = pc.ascii_split_whitespace(cut_more(pc.fill_null(piece.column(0), ""), "")).flatten().value_counts()
                for word, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                    counts[word] += n
                if len(counts) > COUNTED_WORDS:
                    counts = Counter({w: n for w, n in counts.items() if n > 1})
        kept = [(w, n) for w, n in counts.items() if n >= min_in_task and w]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                         names=["word", "n"])
    return run


def frequent_words(documents: DataFrame, limit: int = LEXICON, min_in_task: int = MIN_IN_TASK) -> list[str]:
    """At most ``limit`` words, the most frequent ones (of the last step of counts, any)."""
    counts = (documents.select(F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
              .mapInArrow(_count_words(min_in_task), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # 64 steps for each doubling of the count: at most 4,096 rows for the driver
    counts = written(counts.withColumn("step", F.floor(64 * F.log2("n")).cast("int")), "word-counts")
    steps = {r["step"]: r["count"] for r in counts.groupBy("step").count().collect()}
    room, cut = limit, -1  # words that fit beyond the whole steps, and the step they come from
    for step in sorted(steps, reverse=True):
        if steps[step] > room:
            cut = step
            break
        room -= steps[step]
    chosen = counts.where(F.col("step") > cut).unionByName(counts.where(F.col("step") == cut).limit(room))
    return [r["word"] for r in chosen.select("word").collect()]


def compile_lexicon(spark: SparkSession, words: list[str], vocab: str) -> str | None:
    """Build the automaton, store it in the shared folder and hand the file to
    every executor; returns its name there."""
    if not words:
        return None
    plain = Codec(vocab, None)
    words = sorted(set(words), key=str.encode)
    data = to_bytes(build([w.encode() for w in words], [plain.merge(w) for w in words]))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_dir(spark)}/llm/{name}"
    store_bytes(spark, path, data)
    spark.sparkContext.addFile(path)
    return name


def encode_documents(documents: DataFrame, vocab: str, lexicon: str | None) -> DataFrame:
    """doc_id, ids (array<int>) of every row."""
    def run(batches):
        for batch in batches:
            for piece in sub_batches(batch, 1):
                ids, counts = codec(vocab, lexicon).encode(piece.column(1))
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))],
                                                 names=["doc_id", "ids"])
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocab: str, lexicon: str | None = None) -> DataFrame:
    """doc_id, text: decoded from ids, special tokens included."""
    def run(batches):
        for batch in batches:
            texts = [codec(vocab, lexicon).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def codec_digest(documents: DataFrame, vocab: str, limit: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    lexicon = compile_lexicon(documents.sparkSession, frequent_words(documents, limit), vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocab, lexicon)
        sha = hashlib.sha256
        for batch in batches:
            for piece in sub_batches(batch, 1):
                ids, counts = tool.encode(piece.column(1))
                at, coded, decoded = 0, [], []
                for n in counts.tolist():
                    own = ids[at:at + n].tolist()
                    at += n
                    coded.append(sha(" ".join(map(tool.digits.__getitem__, own)).encode()).hexdigest())
                    decoded.append(sha(tool.decode(own).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts), pa.array(coded), pa.array(decoded)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
