"""op11 against brute force and its SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from racelake.llm import url_rules

from .cases import lower


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    return lower(host), tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def brute(pages, rules, default="allow"):
    out = []
    for page_id, url in pages:
        host, path = parts(url)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max((f[:2] for f in fits), default=None)
        chosen = [f for f in fits if f[:2] == best]
        verdict = default if not chosen else "block" if any(f[3] == "block" for f in chosen) else "allow"
        out.append((page_id, host, path, chosen[0][2] if chosen else None, verdict))
    return sorted(out, key=str)


URLS = [None, "", "no scheme", "://", "http://", "http://a.com", "http://a.com/", "https://WWW.Example.COM/en/1?x=/es/", "x://example.com/en/",
        "http://notexample.com/en/2", "http://example.com#/en/", "http://example.com?q=://net/es/", "http://net/es/a", "http://é.net/fr/ü\nx",
        "http://a..com/en/", "http://com./x", "http://.com/x", "http://example.com:80/en/", "ftp://b.net/fr", "http://a.net/es/" + "p" * 100_000]


def table(spark, rows, n=4):
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(n)
    # names that the operator uses itself
    return df.select("*", *[F.lit("kept").alias(c) for c in ("host", "path", "salt", "row", "best", "key", "block", "verdict")])


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)


def test_contract_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(1, "http://net/es/a")] * 3 + [(None, "http://a.com/x"), (None, None)]
    pages = table(spark, rows)
    assert result(url_rules.judge_urls(pages)) == brute(rows, url_rules.RULES)
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toArrow())
    assert sorted(con.execute(url_rules.oracle()).fetchall(), key=str) == brute(rows, url_rules.RULES)


@pytest.mark.parametrize("partitions", [1, 7])
def test_nested_rules(spark, partitions):
    rnd = random.Random(partitions)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "ab.com", "", "x.org"]
    paths = ["", "/", "/a", "/a/", "/ab", "/a/b/c", "/aé", "/a/b"]
    rules = [(rnd.choice(hosts), rnd.choice(paths), rnd.choice(["allow", "block"])) for _ in range(40)]
    rows = [(i, f"http://{rnd.choice(['', 'www.', 'q.r.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'z', '/b/c', '?a', '#b'])}")
            for i in range(600)]
    rows += [(i, "http://www.a.com/a/b") for i in range(300)]  # a hot url
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = result(url_rules.judge_urls(table(spark, rows), spark.createDataFrame(rules, "host string, path string, verdict string")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows, rules)


def test_no_rows_and_no_rules(spark):
    assert url_rules.judge_urls(table(spark, [])).count() == 0
    none = url_rules.rule_table(spark, [])
    rows = [(1, "http://a.com/x"), (2, None)]
    assert result(url_rules.judge_urls(table(spark, rows), none, default="block")) == brute(rows, [], "block")


def test_kept_rows_keep_their_columns(spark):
    pages = table(spark, [(1, "http://a.net/es/1"), (2, "http://a.com/1"), (2, "http://a.com/1"), (None, None)])
    kept = url_rules.keep_allowed(pages)
    assert kept.columns == pages.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, pages.where("url is null or url like '%com%'").collect()))


def test_plan_is_native(spark):
    plan = url_rules.judge_urls(table(spark, [(1, "http://a.com/")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
