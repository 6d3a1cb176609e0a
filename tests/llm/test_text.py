"""op2, op5, op6, op7, op10 and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from racelake.llm import lang_id, line_dedup, near_dup, pii, quality

from . import cases


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def key(r):
    return -1 if r is None else r


# op2 -------------------------------------------------------------------------

def test_quality_equals_sql(spark):
    docs = cases.documents(spark, ["- a\n- b\n- c " * 20, "cut ...\n" * 30, cases.prose(49), cases.prose(50), "a b c " * 3])
    got = quality.quality_verdicts(docs)
    names = got.columns
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    want = con.execute(quality.oracle()).fetchall()
    order = [c[0] for c in con.description]
    assert sorted(order) == sorted(names)
    at = [order.index(n) for n in names]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in want)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[order.index("kept")] for r in want)
    assert quality.quality_verdicts(cases.empty(spark)).count() == 0


def test_quality_plan_has_no_user_function(spark):
    plan = quality.quality_verdicts(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# op10 ------------------------------------------------------------------------

def line_rule(rows, min_chars=20, min_docs=3):
    def line_key(x):
        return cases.lower(x.strip(" \t\n\r\x0b\x0c"))
    holders = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= min_chars:
                holders[line_key(x)].add(key(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[line_key(x)]) < min_docs or max(holders[line_key(x)]) == key(d)]
        out.append((key(d), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_line_dedup(spark, partitions):
    rnd = random.Random(2)
    pool = [f"line number {i} of the pool of lines" for i in range(12)] + ["short", "", "ÄÖÜ äöü ß é ñ 你好你好你好你"]
    extra = ["\n".join(rnd.choice([x, x.upper(), f"  {x}\r"]) for x in rnd.choices(pool, k=rnd.randint(1, 25))) for _ in range(120)]
    docs = cases.documents(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = line_rule(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.line_dedup_digest(docs).collect()
        assert sorted((key(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == sorted((a, b, c, sha(t)) for a, b, c, t in want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    clean = line_dedup.remove_repeated_lines(docs)
    assert clean.columns == docs.columns
    assert sorted((key(r.doc_id), r.text or "") for r in clean.collect()) == sorted((a, t) for a, _, _, t in want)


def test_line_dedup_empty(spark):
    assert line_dedup.line_dedup_digest(cases.empty(spark)).count() == 0


# op5 -------------------------------------------------------------------------

def check_groups(spark, rows, words):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets, group = cases.groups(rows, words)
    lowest = {}
    for (d, _), g in zip(rows, group, strict=True):
        lowest[g] = min(lowest.get(g, d), d)
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs, words).collect()}
    for (d, _), s, g in zip(rows, sets, group, strict=True):
        assert (got[d].n_shingles, got[d].component_id, got[d].kept) == (len(s), lowest[g], lowest[g] == d)


def test_near_duplicates_of_hard_texts(spark):
    rows = [(100 - i, t) for i, t in enumerate(cases.texts())]
    check_groups(spark, rows, 4)
    check_groups(spark, rows, 5)


def test_long_truncated_copies(spark):
    """One set contains the other, and few of the smallest hashes are shared."""
    rnd = random.Random(2)
    rows = []
    for i in range(20_000):
        w = [f"x{i}y{k}" for k in range(304)]
        n = rnd.randint(244, 250)   # similarity 0.80 to 0.82
        all_, part = (near_dup.shingle_hashes(" ".join(x).encode(), 5) for x in (w, w[:n]))
        if len(np.intersect1d(all_[:near_dup.LISTED], part[:near_dup.LISTED])) < 25:
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(w[:n]))]
            if len(rows) == 12:
                break
    assert len(rows) == 12
    check_groups(spark, rows, 5)


def test_one_large_group_of_near_copies(spark):
    """Edit rates from none to far below the threshold, deletions, shared edits, and
    unrelated texts that quote a common passage."""
    rnd = random.Random(11)
    base = cases.prose(120, 5).split()
    spare = [f"s{i}" for i in range(40)]
    rows = []
    for i in range(260):
        rate = rnd.choice([0, 0.01, 0.02, 0.03, 0.05, 0.08])
        w = [rnd.choice(spare) if rnd.random() < rate else x for x in base]
        if rnd.random() < 0.3:
            w = w[:rnd.randint(95, 120)]
        rows.append((i, " ".join(w)))
    passage = cases.prose(60, 9)
    rows += [(300 + i, passage + " " + " ".join(f"u{i}x{k}" for k in range(rnd.randint(5, 60)))) for i in range(60)]
    rnd.shuffle(rows)
    check_groups(spark, rows, 4)


def test_near_duplicates_null_ids_and_repeats(spark):
    docs = cases.documents(spark)
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    nameless = sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles in (0, 196))
    assert nameless == [(0, None, True), (196, 11, False)]
    first = near_dup.keep_first(docs)
    assert first.columns == docs.columns and first.count() == sum(r.kept for r in got)
    assert near_dup.near_duplicates(cases.empty(spark)).count() == 0


# op6 -------------------------------------------------------------------------

def code_length(text, counts, order):
    """Bits of a text by the definition: counts[context][byte] of one language."""
    bits = 0.0
    for i, b in enumerate(text):
        p = 1.0
        for k in range(min(order, i), -1, -1):
            seen = counts.get(text[i - k:i])
            if not seen:
                continue
            n, t = sum(seen.values()), len(seen)
            if b in seen:
                p *= seen[b] / (n + t)
                break
            p *= t / (n + t)
        else:
            p /= 256
        bits -= math.log2(p)
    return bits


def test_ppm_code_lengths_by_definition(spark):
    rnd = random.Random(1)
    alphabets = {"aa": "abcd ", "bb": "acef é"}
    rows = [(i, "".join(rnd.choice(alphabets[lang]) for _ in range(60)), lang) for i in range(40) for lang in alphabets]
    docs = spark.createDataFrame([(2 * i + (lang == "bb"), t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    model = lang_id.train(docs)
    learned = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    trees = {}
    for lang in alphabets:
        tree = defaultdict(Counter)
        for r in learned:
            if r.lang == lang:
                data = r.text.encode()
                for i, b in enumerate(data):
                    for k in range(min(lang_id.ORDER, i) + 1):
                        tree[data[i - k:i]][b] += 1
        trees[lang] = tree
    # contexts of full length near a text's start are shorter ones
    tests = [b"abcd dcba", "acéf".encode(), b"zzz", b"", b"a", bytes(range(1, 40))]
    got = lang_id.Scorer(model).code_lengths(tests)
    for text, row in zip(tests, got, strict=True):
        for lang, bits in zip(model["langs"], row.tolist(), strict=True):
            assert bits == pytest.approx(code_length(text, trees[lang], lang_id.ORDER), rel=1e-5, abs=1e-6)


def test_language_id(spark):
    rnd = random.Random(3)
    words = {"en": "the of and to in that house water".split(), "de": "der die und das nicht haus wasser für".split()}
    rows = [(i, " ".join(rnd.choices(words[lang], k=30)), lang) for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "123 ½ ² _", "en"), (None, "der die und", "de"), (1003, "the of and", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lang_id.identify(docs).collect()}
    assert len(got) == len(rows)
    for d, _, lang in rows[:120]:
        assert got[d].lang_pred == lang and 0 <= got[d].score <= 1
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (1000, 1001, 1002))
    assert got[None].lang_pred == "de" and got[1003].lang_pred == "en"
    # lang and source play no part in a prediction
    model = lang_id.train(docs)
    bare = {r.doc_id: r.lang_pred for r in lang_id.predict(docs.select("doc_id", "text"), model).collect()}
    assert bare == {d: r.lang_pred for d, r in got.items()}
    odd = lang_id.identify(cases.documents(spark))
    assert odd.count() == cases.documents(spark).count()
    assert lang_id.identify(cases.empty(spark)).count() == 0
    nothing = lang_id.identify(docs.withColumn("lang", docs.lang.substr(1, 0)).where("doc_id = 5"))
    assert nothing.count() == 1


def test_many_languages_in_mixed_scripts(spark, monkeypatch):
    """Twelve languages, one of them with few rows: none is cut by the others, whatever
    a task does at once and remembers."""
    starts = [0x61, 0x3B1, 0x430, 0x5D0, 0x627, 0x915, 0xE01, 0x10D0, 0x1200, 0x3042, 0x4E00, 0xAC00]
    rnd = random.Random(12)
    rows = []
    for n, start in enumerate(starts):
        words = ["".join(chr(start + rnd.randrange(24)) for _ in range(rnd.randint(2, 7))) for _ in range(60)]
        for _ in range(4 if n == 5 else 40):
            rows.append((len(rows), " ".join(rnd.choices(words, k=25)), f"l{n:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in lang_id.identify(docs).collect()}
    assert got == {d: lang for d, _, lang in rows}
    model = lang_id.train(docs)
    assert model["langs"] == [f"l{n:02d}" for n in range(12)]
    texts = [t.encode() for _, t, _ in rows]
    want = lang_id.Scorer(model).code_lengths(texts)
    for size in (1, 12 * 5000):
        monkeypatch.setattr(lang_id, "CHUNK", size)
        monkeypatch.setattr(lang_id, "REMEMBERED", size)
        assert np.allclose(lang_id.Scorer(model).code_lengths(texts), want, rtol=1e-9)


def test_held_out_accuracy_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in lang_id.identify(docs).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in got]) > 0.97


# op7 -------------------------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(p) < 256 for p in m.group().split("."))) or (
                    kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark):
    rnd = random.Random(8)
    parts = ["a", "b.c", "@", ".", "+", "-", "_", "1", "22", "255", "256", "4111111111111111", "+1 (499) 555-6503", "10.0.0.1", " ", "\n", "x@y.z", "é", "😀"]
    extra = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    docs = cases.documents(spark, extra)
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    got = pii.pii_spans(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            continue
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want)), texts[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x, _ in PATTERNS)
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("term")] == [f"{k}:{a}:{b}" for k, a, b in want]
        taken = {i for _, a, b in want for i in range(a, b)}
        for s in spans[len(want):]:
            a, b = map(int, s.split(":")[1:])
            assert texts[r.doc_id][a:b].isalpha() and not taken & set(range(a, b))
    assert pii.pii_spans(cases.empty(spark)).count() == 0


def test_disclosing_terms(spark):
    rnd = random.Random(4)
    common = [f"{a}{b}word" for a in "abcdefgh" for b in "ijklmnop"]

    def filler(n):
        return " ".join(rnd.choice(common) for _ in range(n))
    rows = [(i, filler(30)) for i in range(200)]
    # "Zeppelin" stands beside one address only; "common" words stand everywhere
    rows += [(200 + i, f"{filler(8)}\nask Zeppelin, at zed@example.org please\n{filler(8)}") for i in range(5)]
    rows += [(300 + i, f"{filler(8)} write {rnd.choice(common)} p{i}@example.org") for i in range(20)]
    rows += [(400, "Zeppelin far from the address " + filler(40) + " zed@example.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {}
    for r in pii.pii_spans(docs).collect():
        found[r.doc_id] = [texts[r.doc_id][int(a):int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"]
    assert all(not found[i] for i in range(200))
    for i in range(200, 205):
        assert "Zeppelin" in found[i] and not set(found[i]) & set(common)
    assert found[400] == ["Zeppelin"]  # far away, in a document that holds the entity
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all(clean[i] == texts[i] for i in range(200))
    for i in range(200, 205):
        assert "Zeppelin" not in clean[i] and "zed@" not in clean[i] and "[EMAIL]" in clean[i]
    assert "Zeppelin" not in clean[400] and clean[400].endswith("[EMAIL]") and "far from the address" in clean[400]


def term_words(rows, got):
    texts = dict(rows)
    return {r.doc_id: [texts[r.doc_id][int(a):int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"]
            for r in got}


def test_terms_of_rare_entities(spark):
    """Entities of one or two documents, and a name on the line above; a term seen beside
    its entity once only tells nothing."""
    rows = [(i, "some plain words that stand in every text") for i in range(200)]
    rows += [(300, "some plain words\nZeppelin\nzed@example.org\nZeppelin"), (301, "every text by Quux at 10.1.2.3"),
             (302, "words by Quux, 10.1.2.3"), (303, "we saw zebra at the zoo, write to a@b.cc today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = term_words(rows, pii.pii_spans(docs).collect())
    assert found[300] == ["Zeppelin", "Zeppelin"] and found[301] == found[302] == ["Quux"] and found[303] == []
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[300] == "some plain words\n[TERM]\n[EMAIL]\n[TERM]" and "Quux" not in clean[301] + clean[302]
    assert clean[303] == "we saw zebra at the zoo, write to [EMAIL] today"


def test_terms_are_removed_where_the_evidence_is_strong(spark):
    rows = [(i, "plain words of every text") for i in range(3000)]
    rows += [(5000 + i, "Zeppelin zed@example.org\n" + "plain words " * 30 + "Zeppelin") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).where("doc_id >= 5000").collect()}
    assert set(clean.values()) == {" [EMAIL]\n" + "plain words " * 30}


def test_names_that_the_operators_use_themselves(spark):
    """Columns named like an operator's own pass through all stages untouched."""
    odd = ["__rid", "__spans", "__hits", "__doc", "__tx", "__keep", "__q_words", "__q_kept", "__gdoc", "x0", "rid", "row"]
    docs = cases.documents(spark).select("doc_id", "text", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in odd])
    for stage in (quality.keep_good, line_dedup.remove_repeated_lines, near_dup.keep_first, pii.sanitise):
        out = stage(docs)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in odd)


def test_pairs_of_texts_with_very_many(spark, monkeypatch):
    rows = [(i, f"some words of Name{'abcdefghij'[i % 10]} a{i % 10}@example.org and Other{'klmnopqrst'[i % 10]} 10.0.0.{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(pii.pii_spans(docs).collect())
    monkeypatch.setattr(pii, "_PAIRS", 0)
    assert sorted(pii.pii_spans(docs).collect()) == want and sum(r.n_terms for r in want) > 0


def test_window_goes_on_past_other_matches(spark):
    rows = [(i, "invoice card text and plain words 17") for i in range(200)]
    rows += [(300 + i, "Meier, invoice 17, card 4111 1111 1111 1111") for i in range(5)]
    rows += [(400 + i, "a@b.cc, d@e.ff Johann") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = term_words(rows, pii.pii_spans(docs).collect())
    assert all(found[300 + i] == ["Meier"] and found[400 + i] == ["Johann"] for i in range(5))
    # a valid match between the address and the name
    rows = rows[:200] + [(500 + i, f"a@b.cc, x{i}@e.ff Johann") for i in range(5)] + [(600 + i, f"x{i}@e.ff and plain") for i in range(5)]
    near = pii._near_terms
    hits = pii.written(pii._hits(spark.createDataFrame(rows[200:205], "doc_id long, text string")), "t")
    occurrences = pii._occurrences(hits)
    pairs = {(r.entity, r.term) for r in near(pii._terms(hits, occurrences), occurrences).collect()}
    assert ("email:a@b.cc", "johann") in pairs


def test_sanitise_keeps_rows_and_columns(spark):
    docs = cases.documents(spark)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    before = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in clean.collect():
        if r.doc_id is not None and not base_spans(before[r.doc_id] or ""):
            assert r.text == before[r.doc_id]
        elif r.doc_id is not None and "jane@" in before[r.doc_id]:
            assert r.text == "Write to [EMAIL] or [PHONE] now\nserver [IP] and 999.1.1.1"


def test_pii_plan_has_no_user_function(spark):
    plan = pii._hits(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# pipeline --------------------------------------------------------------------

def test_pipeline_by_brute_force(spark, tmp_path):
    rnd = random.Random(6)
    stop = "the of and to in a is that for with on as".split()

    def good(seed):
        r = random.Random(seed)
        return " ".join(r.choice(stop) if r.random() < 0.4 else f"word{r.randint(0, 400)}" for _ in range(90))
    shared = "this very long line of the text is shared by all of them"
    texts = [good(i) for i in range(12)]
    texts += [f"{good(20 + i)}\n{shared}\n{good(40 + i)}" for i in range(4)]
    texts += [texts[0], texts[1] + " tail", "too short", "$$$ " * 80, None, f"{good(70)} call jane@example.org today"]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    folder = str(tmp_path / "sf")
    docs = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(folder + "/documents.parquet")
    # the same by hand
    kept = [(d, t) for d, t in rows if t and len(t.split()) >= 50 and "$" not in t]
    kept = [(d, t) for (d, _), (_, _, _, t) in zip(kept, line_rule(kept), strict=True)]
    _, group = cases.groups(kept, 5)
    lowest = {}
    for (d, _), g in zip(kept, group, strict=True):
        lowest[g] = min(lowest.get(g, d), d)
    kept = [(d, t) for (d, t), g in zip(kept, group, strict=True) if lowest[g] == d]
    want = {}
    from tokenizers import Tokenizer

    from racelake.llm.tokenizing import vocabulary
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for d, t in kept:
        t = t.replace("jane@example.org", "[EMAIL]")
        want[d] = [*tok.encode(t, add_special_tokens=False).ids, 2]
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for d, pieces in got.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[d])
            assert r.ids_crc32 == zlib.crc32(np.array(want[d][at:at + r.length], "<u4").tobytes())
            at += r.length
    # every stage but the last returns the columns of documents
    names = docs.columns
    step = spark.read.parquet(folder + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder)
        assert step.columns == names


def test_stages_on_hard_rows(spark):
    step = cases.documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, "")
        step.count()
    step = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, "")
        assert step.count() == 0
