"""op13 against brute force and its SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from racelake.llm import oracles, resample

from . import cases


def grams(text, max_n):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", cases.lower(text or ""))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, max_n, buckets=10_000, percent=10):
    def counts(texts):
        return Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t, max_n)[1])
    s, t = counts(x for _, x in rows), counts(target)
    s_all, t_all = s.total() + buckets, t.total() + buckets
    out = []
    for doc_id, text in rows:
        n_words, gs = grams(text, max_n)
        gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in (zlib.crc32(g.encode()) % buckets for g in gs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


TARGET = [None, "", "the of and to in a", cases.prose(300, 1), "Ünïcödé 你好 w1 W1", "x\x00y z"]


@pytest.fixture()
def tables(spark):
    extra = [cases.prose(15 + i, i) for i in range(60)] + [" ".join(["w5 w7 The of,and"] * i) for i in range(40)]
    docs = cases.documents(spark, extra)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    return docs, target, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_resample(tables, max_n):
    docs, target, rows = tables
    want = brute(rows, TARGET, max_n)
    assert result(resample.resample(docs, target, max_n=max_n)) == want
    assert sum(r[4] is not None for r in want) > 5


def test_sql_gives_the_same(tables):
    docs, target, rows = tables
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    con.register("benchmark", target.toArrow())
    assert sorted(con.execute(oracles.RESAMPLE).fetchall(), key=str) == brute(rows, TARGET, 1)


def test_small_passes_give_the_same(tables, monkeypatch):
    docs, target, rows = tables
    got = resample.bucket_counts(docs)
    monkeypatch.setattr(resample, "PASS_BYTES", 100)
    assert (resample.bucket_counts(docs) == got).all()
    assert got.sum() == sum(len(grams(t, 1)[1]) for _, t in rows)


def test_empty_tables(spark, tables):
    docs, target, rows = tables
    assert resample.resample(cases.empty(spark), target).count() == 0
    assert result(resample.resample(docs, target.limit(0))) == brute(rows, [], 1)
