"""op1, op3, op9 and op4: ids, coding, packing and counts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from racelake.llm import bpe_codec, packing, simple8b, token_counts, token_output, transducer
from racelake.llm.common import fresh_path
from racelake.llm.tokenizing import Encoder, vocabulary

from . import cases

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
PARTS = ["a", "B", "é", "É", "ß", "İ", "Σ", "1", "²", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", ".", ",", "'s", "'",
         "<|endoftext|>", "<|startoftext|>", "<|", "你", "😀", "\x00", "don't", "ﬁ", "̈", "-", "word", "The"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def weird():
    rnd = random.Random(5)
    return [None, "", *("".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(4000))]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path, weird):
    tok, own = Tokenizer.from_file(path), Encoder(path)
    ids, counts = own.encode_many(pa.array(weird), 7)
    at = 0
    for text, n in zip(weird, counts.tolist(), strict=True):
        want = tok.encode(text or "", add_special_tokens=False).ids
        assert ids[at:at + n].tolist() == [*want, 7], text
        assert np.frombuffer(own.encode(text or ""), "<u4").tolist() == want
        at += n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(2**20 - 3, 2**20 + 3), st.integers(0, 2**64 - 1)), max_size=400),
       st.integers(0, 400), st.integers(0, 400))
def test_simple8b_round_trip(ids, lo, hi):
    a = np.array(ids, np.uint64)
    words, escapes, offsets = simple8b.encode(a)
    assert (simple8b.decode(words, escapes, a.size) == a).all()
    lo, hi = sorted((min(lo, a.size), min(hi, a.size)))
    assert (simple8b.decode_range(words, escapes, offsets, a.size, lo, hi) == a[lo:hi]).all()


def test_rare_wide_ids_do_not_widen_the_others():
    ids = np.full(6000, 5, np.uint64)
    plain = len(simple8b.encode(ids)[0])
    ids[3000] = 2**40
    words, escapes, _ = simple8b.encode(ids)
    assert len(words) <= plain + 16 and len(escapes) == 8


def test_token_file(spark):
    docs = cases.documents(spark)
    tok = Tokenizer.from_file(BYTE)
    rows = docs.select("doc_id", "text").collect()
    path = fresh_path(spark, "tokens")
    token_output.write_token_file(docs, path, BYTE, 0)
    got = sorted(token_output.read_token_file(spark, path).collect(), key=lambda r: r["start"])
    want = sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()))
                  for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    for r in token_output.decode_documents(spark, path).collect():
        if r.doc_id is not None:
            assert tok.decode(r.ids[:-1], skip_special_tokens=False) == Tokenizer.from_file(BYTE).decode(
                tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, skip_special_tokens=False)
    assert token_output.token_output(cases.empty(spark), BYTE).count() == 0


def test_transducer_is_minimal_and_exact():
    words = sorted({w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "é", "éa", "x" * 300)})
    t = transducer.Transducer(transducer.to_bytes(transducer.build(words, [[i] for i in range(len(words))])))
    asked = [*words, b"", b"ta", b"tapsx", b"zz", b"x" * 299]
    data = np.frombuffer(b"".join(asked), np.uint8)
    ends = np.cumsum([len(w) for w in asked])
    starts = ends - [len(w) for w in asked]
    assert t.places(data, starts, ends).tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    # tap(s), top(s) and stop(s) share their ends: states of the smallest automaton
    languages = set()
    for w in words:
        for i in range(len(w) + 1):
            languages.add(frozenset(x[i:] for x in words if x[:i] == w[:i]))
    assert t.final.size == len(languages)


def test_codec(spark, weird):
    tok = Tokenizer.from_file(WORD)
    docs = cases.documents(spark, weird[:300])
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = sorted((-1 if d is None else d, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
                  for d, t in rows for ids in [tok.encode(t, add_special_tokens=False).ids])
    for limit in (0, 20, 150_000):
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                     for r in bpe_codec.codec_digest(docs, WORD, limit).collect())
        assert got == want
    encoded = bpe_codec.encode_documents(docs, WORD, None)
    back = bpe_codec.decode_documents(encoded, WORD)
    assert sorted(sha(r.text) for r in back.collect()) == sorted(w[3] for w in want)
    assert bpe_codec.codec_digest(cases.empty(spark), WORD).count() == 0


def test_assign_fills_sequences_and_prefers_low_cost():
    sizes = np.array([10_000, 4096, 1, 5, 3000, 3000, 2000, 700])
    pieces = packing.assign(sizes, 4096)
    room = defaultdict(int)
    parts = defaultdict(list)
    for doc, at, n, seq, offset in pieces:
        assert offset == room[seq] and n > 0
        room[seq] += n
        parts[doc].append((at, n))
    assert max(room.values()) <= 4096 and len(room) == -(-int(sizes.sum()) // 4096)
    for doc, cut in parts.items():
        at = 0
        for start, n in sorted(cut):
            assert start == at
            at += n
        assert at == sizes[doc]
    # two long pieces start apart: the empty sequence is the cheaper one
    two = packing.assign(np.array([1500, 1500, 1500]), 4096)
    assert len({s for *_, s, _ in two[:2]}) == 2


def test_packing(spark):
    docs = cases.documents(spark)
    tok = Tokenizer.from_file(WORD)
    want = sorted(zlib.crc32(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
                  for r in docs.select("text").collect() if len(tok.encode(r.text or "", add_special_tokens=False).ids) < 50)
    got = packing.pack_documents(docs, WORD).collect()
    assert sorted(r.ids_crc32 for r in got if r.doc_tokens <= 50 and r.length == r.doc_tokens) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096
    total = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.select("text").collect())
    assert sum(r.length for r in got) == total
    small = packing.pack_documents(docs, WORD, window=5000).collect()  # several windows a task
    assert sum(r.length for r in small) == total and len({r.sequence_id for r in small}) <= -(-total // 4096) + 3 * (total // 5000 + 1)
    assert packing.pack_documents(cases.empty(spark), WORD).count() == 0


def events(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, version string, op string, n_tokens long")


def test_rollup(spark):
    r = token_counts.Rollup(spark, fresh_path(spark, "rollup"))

    def totals():
        return {(x.source, x.lang, x.version): (x.n_docs, x.n_tokens) for x in r.totals().collect()}
    assert totals() == {}
    load = events(spark, [(1, "a", "en", "v1", "insert", 10), (2, "a", "en", "v1", "insert", 5), (3, None, None, "v1", "insert", 7),
                          (1, "a", "en", "v2", "insert", 12), (2, "a", "en", "v1", "insert", 5), (None, "a", "en", "v1", "insert", 1)])
    assert r.apply_batch("load", load) and not r.apply_batch("load", load)
    assert totals() == {("a", "en", "v1"): (3, 16), (None, None, "v1"): (1, 7), ("a", "en", "v2"): (1, 12)}
    # a revision moves a document to another source; unknown ones change nothing
    change = events(spark, [(1, "b", "en", "v1", "revise", 20), (9, "b", "en", "v1", "revise", 99), (3, None, None, "v1", "delete", None),
                            (8, None, None, "v1", "delete", None), (None, "a", "en", "v1", "delete", 1)])
    assert r.apply_batch("change", change)
    assert totals() == {("a", "en", "v1"): (2, 6), ("b", "en", "v1"): (1, 20), ("a", "en", "v2"): (1, 12)}
    r.compact()
    assert not r.apply_batch("change", change)
    # a failed attempt leaves its tables but no marker: it counts for nothing, its rerun once
    broken = token_counts.Rollup(spark, r.path)
    broken._mark = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    again = events(spark, [(3, "a", "en", "v1", "insert", 4), (2, "a", "en", "v1", "delete", None), (2, "a", "en", "v1", "insert", 50)])
    with pytest.raises(RuntimeError):
        broken.apply_batch("again", again)
    assert totals()["a", "en", "v1"] == (2, 6)
    assert r.apply_batch("again", again)
    assert totals()["a", "en", "v1"] == (2, 5)
    assert r.apply_batch("nothing", events(spark, []))
    r.compact()
    assert totals() == {("a", "en", "v1"): (2, 5), ("b", "en", "v1"): (1, 20), ("a", "en", "v2"): (1, 12)}
    assert {(x.doc_id, x.version): x.n_tokens for x in r.ledger().collect()} == {(1, "v1"): 20, (1, "v2"): 12, (3, "v1"): 4}


def test_interrupted_compact_changes_nothing(spark):
    """A snapshot counts from its marker on: what a lost run left behind is not read."""
    r = token_counts.Rollup(spark, fresh_path(spark, "rollup"))

    def totals():
        return [(x.source, x.n_docs, x.n_tokens) for x in r.totals().collect()]
    r.apply_batch("load", events(spark, [(i, "a", "en", "v1", "insert", i) for i in range(100)]))
    spark.range(3).write.parquet(f"{r.path}/snapshots/000000000001")
    spark.range(3).write.parquet(f"{r.path}/ledger-snapshots/000000000001/split=0")
    assert totals() == [("a", 100, 4950)] and r.ledger().count() == 100
    lost = token_counts.Rollup(spark, r.path)
    lost._write_ledger = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        lost.compact()
    assert r.snapshot() == 0 and totals() == [("a", 100, 4950)]
    r.compact()
    assert r.snapshot() == 1 and totals() == [("a", 100, 4950)] and r.ledger().count() == 100
    r.compact()  # nothing new: the published snapshot stays as it is
    r.apply_batch("less", events(spark, [(5, None, None, "v1", "delete", None), (6, "a", "en", "v1", "revise", 1000)]))
    assert totals() == [("a", 99, 4950 - 5 - 6 + 1000)]
    r.compact()
    assert r.snapshot() == 2 and totals() == [("a", 99, 5939)] and r.ledger().count() == 99
    r.apply_batch("back", events(spark, [(5, "a", "en", "v1", "insert", 5)]))
    assert totals() == [("a", 100, 5944)]


def test_a_batch_reads_only_the_splits_of_its_documents(spark):
    r = token_counts.Rollup(spark, fresh_path(spark, "rollup"))
    r.apply_batch("load", events(spark, [(i, "a", "en", "v1", "insert", i) for i in range(500)]))
    r.compact()
    rows = r._ledger_rows([3])
    assert 0 < rows.count() < 60
    assert "PartitionFilters: [isnotnull(split" in rows._jdf.queryExecution().executedPlan().toString()


def test_frequent_words_are_never_more_than_the_limit(spark):
    rows = [("aa bb cc dd ee " * 12_000 + "rare ",)] + [("ff gg " * 40,)]
    docs = spark.createDataFrame(rows, "text string")
    for limit in (0, 2, 5, 6, 7):
        words = bpe_codec.frequent_words(docs, limit, min_in_task=1)
        assert len(words) == len(set(words)) == limit
        assert set(words) <= set("aa bb cc dd ee".split()) or limit > 5


def test_corpus_rollup(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(11, 1, 1), (11, 1, 1), (13, 0, 0), (None, 1, 1), (12, None, None)], "doc_id long, quality int, toxic int")
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens)
           for r in token_counts.corpus_rollup(docs, labels, {"w": WORD}, fresh_path(spark, "rollup")).collect()}
    tok, want = Tokenizer.from_file(WORD), defaultdict(lambda: [0, 0])
    # rows of one doc_id: the largest source wins
    rows = {(r.doc_id, r.text if r.doc_id is None else ""): r for r in sorted(docs.collect(), key=lambda r: r.source or "")}
    for r in rows.values():
        if r.doc_id == 11:
            continue
        text = r.text or ""
        if r.doc_id is not None:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        want[r.source, r.lang, "w"][0] += 1
        want[r.source, r.lang, "w"][1] += len(tok.encode(text, add_special_tokens=False).ids)
    assert got == {k: tuple(v) for k, v in want.items()}
