"""op11: url rules by a sort-merge range join, with DataFrame functions alone.

A canonical key is a host with its labels reversed, a slash, and the path:
``www.example.com`` with ``/en/1`` becomes ``com.example.www//en/1``.  Hosts hold no
slash, so a rule's key is a prefix of a key exactly if hosts are equal and the path
starts with the rule's path.  All keys with one prefix form an interval from the prefix
itself to the prefix and the byte FF, which no UTF-8 text holds.  Such intervals are
nested or apart, never crossed.

The rules are swept in key order over the starts and ends of their intervals.  The
running sum of +1 and -1 is the height of the stack of active rules, and the last start
at each height is the rule in that cell; so every start or end knows which rule is on
top after it.  Then the keys of the urls are sorted in between, and each takes the top
that the last start or end before it left behind.  To fit subdomains too, a url asks
once for each of its host's suffixes (a.b.com, b.com, com); the longest answer wins.

Both sweeps run over range partitions.  What one hands to the next (a sum, the cells, a
top) is one summary row a partition; only these rows meet in one task.  Many urls with
one key are first reduced to one a salt, and range borders may fall within a key, so
neither a hot host nor a hot url lands in one task.

Results.  Null url or one without ``://``: host and path are empty, and only a rule with
empty host and path fits.  A rule's null host or path counts as empty.  Longest: most
code points of host and path together; equal: the longer host.  A rule given twice with
both verdicts blocks.  An empty path fits every path; a url without a path does not fit
a rule with path ``/``.  Repeated pages are judged row by row.  No pages: no rows; no
rules: every page gets the default verdict.  Other columns are never read by name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

#: Rules of the contract query: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Rows of one url are reduced to at most this many before the sweep.
SALTS = 64


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """A few rules given in code, as a table (host, path, verdict)."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "verdict"), r, strict=True)]) for r in rules])
    return spark.range(1).select(F.inline(rows))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty if there is no ``://``."""
    mark = F.instr(url, "://")
    after = F.coalesce(F.when(mark > 0, F.substring(url, mark + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def key(labels: Column, path: Column) -> Column:
    """Canonical key of host labels (in their usual order) and a path."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path).cast("binary")


def _sorted_blocks(events: DataFrame, order: list[str], name: str) -> DataFrame:
    """``events`` range-partitioned by ``order`` and written, with the partition's place."""
    return written(events.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), name)


def _running(block_order: list[str]):
    return Window.partitionBy("block").orderBy(*block_order).rowsBetween(Window.unboundedPreceding, 0)


def _before():
    """All earlier blocks; for tables of one row a block."""
    return Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def rule_sweep(rules: DataFrame) -> DataFrame:
    """Starts and ends of all rules: (key, top), the rule on top of the stack from there on.

    ``rules``: host, path, verdict.  ``top`` is (length, host_length, rule, verdict),
    null where no rule is active."""
    host, path = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("host", "path")]
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    given = rules.select(host.alias("host"), path.alias("path"), F.col("verdict").cast("string").alias("verdict"))
    one = given.groupBy("host", "path").agg(F.when(F.max(F.col("verdict") == "block"), "block").otherwise(F.min("verdict")).alias("verdict"))
    rule = F.struct(F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"),
                    F.concat("host", "path").alias("rule"), "verdict")
    start = key(F.split("host", r"\."), F.col("path"))
    events = one.select(rule.alias("rule"), F.inline(F.array(
        F.struct(start.alias("key"), F.lit(1).alias("step")),
        F.struct(F.concat(start, F.lit(b"\xff")).alias("key"), F.lit(-1).alias("step")))))
    events = _sorted_blocks(events, ["key"], "rule-events")

    # height of the stack: running sum within a block, plus the sum of all blocks before
    sums = events.groupBy("block").agg(F.sum("step").alias("sum"))
    before = sums.select("block", F.coalesce(F.sum("sum").over(_before()), F.lit(0)).alias("base"))
    height = F.col("base") + F.sum("step").over(_running(["key"]))
    # a rule's own cell: the height after its start, or before its end
    events = written(events.join(F.broadcast(before), "block")  # one row a block
                     .select("block", "key", "step", "rule", (height + F.when(F.col("step") < 0, 1).otherwise(0)).alias("cell")), "rule-heights")
    deepest = events.agg(F.max("cell")).first()[0] or 0

    def started(level):
        return F.when((F.col("cell") == level) & (F.col("step") > 0), F.col("rule"))
    levels = range(1, deepest + 1)
    if not levels:
        return events.select("key", F.col("rule").alias("top"))
    last = events.groupBy("block").agg(*[F.max_by(started(i), F.when(started(i).isNotNull(), F.col("key"))).alias(f"c{i}") for i in levels])
    carry = last.select("block", *[F.last(f"c{i}", ignorenulls=True).over(_before()).alias(f"c{i}") for i in levels])
    cells = [F.coalesce(F.last(started(i), ignorenulls=True).over(_running(["key"])), F.col(f"c{i}")) for i in levels]
    swept = events.join(F.broadcast(carry), "block").select("key", "step", "rule", "cell", F.array(*cells).alias("cells"))
    # an end uncovers the rule one cell below; cells start at 1, so below the first is nothing
    below = F.get("cells", F.col("cell") - 2)
    return swept.select("key", F.when(F.col("step") > 0, F.col("rule")).otherwise(below).alias("top"))


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, salt; distinct) with the longest fitting rule, null if none:
    (host, path, salt, best), best = (length, host_length, rule, verdict)."""
    tops = rule_sweep(rules)
    labels = F.split("host", r"\.")
    asked = urls.select("host", "path", "salt", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.slice(labels, i, F.size(labels)))).alias("labels"))
    # at one key a rule's start comes before the urls that equal it
    events = tops.select("key", F.lit(0).alias("asks"), "top", *[F.lit(None).cast(t).alias(c) for c, t in
                                                                  (("host", "string"), ("path", "string"), ("salt", "int"))])
    asked = asked.select(key(F.col("labels"), F.col("path")).alias("key"), F.lit(1).alias("asks"),
                         F.lit(None).cast(tops.schema["top"].dataType).alias("top"), "host", "path", "salt")
    order = ["key", "asks", "host", "salt"]  # host and salt only split a hot key
    events = _sorted_blocks(events.unionByName(asked), order, "url-events")

    def state():  # a top that is null means an empty stack, so it is wrapped
        return F.when(F.col("asks") == 0, F.struct("top"))
    last = events.groupBy("block").agg(F.max_by(state(), F.when(F.col("asks") == 0, F.col("key"))).alias("state"))
    carry = last.select("block", F.last("state", ignorenulls=True).over(_before()).alias("carry"))
    now = F.coalesce(F.last(state(), ignorenulls=True).over(_running(order)), F.col("carry"))
    swept = events.join(F.broadcast(carry), "block").select("asks", "host", "path", "salt", now["top"].alias("top"))
    return swept.where("asks = 1").groupBy("host", "path", "salt").agg(F.max("top").alias("best"))


def _judged(pages: DataFrame, rules: DataFrame, default: str, url: str, salt_by: list[str]) -> DataFrame:
    """Every row of ``pages`` as a struct, with host, path, rule and verdict."""
    host, path = host_and_path(F.col(url).cast("string"))
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int")
    rows = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"), salt.alias("salt"))
    found = fitting_rules(rows.select("host", "path", "salt").distinct(), rules)
    return rows.join(found, ["host", "path", "salt"], "left").select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url)."""
    rules = rule_table(pages.sparkSession) if rules is None else rules
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    return _judged(rows, rules, default, "url", ["page_id"]).select("row.page_id", "host", "path", "rule", "verdict")


def keep_allowed(pages: DataFrame, rules: DataFrame | None = None, default: str = "allow", url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, all columns as they were."""
    rules = rule_table(pages.sparkSession) if rules is None else rules
    salt_by = [c for c, t in pages.dtypes if not t.startswith(("map", "variant"))][:8]
    return _judged(pages, rules, default, url, salt_by).where("verdict <> 'block'").select("row.*")


def oracle(rules=RULES, default: str = "allow") -> str:
    """The same verdicts in DuckDB SQL: every rule against every url."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rules)
    lower = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    return f"""
WITH r(rhost, rpath, verdict) AS (VALUES {values}
), u AS (
  SELECT row_number() OVER () AS uid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT uid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), f AS (
  SELECT h.*, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY uid ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC, verdict DESC) AS place
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM f WHERE place = 1"""
