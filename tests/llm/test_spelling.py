"""op12 against brute force and its SQL."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from racelake.llm import oracles, spelling

from . import cases


def brute(rows, min_chars=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", cases.lower(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_chars and c >= min_count}
    variants = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            variants[w[:i] + "_" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in variants.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n) if n else []


def key(r):
    return str(r[0])


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=key)


def docs(spark):
    rnd = random.Random(4)
    stems = ["colour", "center", "überall", "straße", "aaaaa", "abcde", "éàèùÿ", "organise", "thereon", "onthere"]

    def change(w):
        i = rnd.randrange(len(w) + 1)
        c = rnd.choice("abceé×")
        return rnd.choice([w, w, w, w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i + 1:] + c])
    extra = [" ".join(change(change(rnd.choice(stems))) for _ in range(rnd.randint(0, 150))) for _ in range(80)]
    return cases.documents(spark, [*extra, "COLOUR Colour ÜBERALL überall " * 3, "x" * 50_000 + " " + "x" * 50_001 + " ", "colour-" * 400])


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_spelling_groups(spark, hot):
    rows = docs(spark)
    want = sorted(brute([(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]), key=key)
    assert result(spelling.spelling_groups(rows, hot=hot)) == want
    assert any(r[1] for r in want) and any(r[2] != r[1] for r in want if r[1])


def test_sql_gives_the_same(spark):
    rows = docs(spark)
    con = duckdb.connect()
    con.register("documents", rows.select("doc_id", "text").toArrow())
    assert sorted(con.execute(oracles.SPELLING).fetchall(), key=key) == result(spelling.spelling_groups(rows))


def test_near_words_share_a_signature(spark):
    rnd = random.Random(1)
    pairs = []
    for _ in range(500):
        w = "".join(rnd.choice("abcé") for _ in range(rnd.randint(5, 9)))
        i = rnd.randrange(len(w))
        pairs.append((w, rnd.choice([w[:i] + "z" + w[i + 1:], w[:i] + w[i + 1:], w[:i] + "a" + w[i:]])))
    df = spark.createDataFrame(pairs, "a string, b string")
    from pyspark.sql import functions as F
    assert df.where(~F.arrays_overlap(spelling.signatures(F.col("a")), spelling.signatures(F.col("b")))).count() == 0


def test_no_words(spark):
    assert result(spelling.spelling_groups(cases.empty(spark))) == []
    assert result(spelling.spelling_groups(spark.createDataFrame([(1, None), (None, "ab")], "doc_id long, text string"))) == []
