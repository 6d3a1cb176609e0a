"""op2: quality rules, a threshold table compiled into one Spark projection.

Metrics are plain column expressions (no user functions); ``RULES`` states, per
rule, which metric may not be below or above which share of which other metric.
``compile_rules`` turns the table into boolean columns.  All comparisons are in
whole numbers, so any SQL engine gives the same verdicts.

Words are runs of anything but ASCII white space.  Null text has no words, no
lines with words and fails the base rule; so does empty text.  Repeated rows and
ties are judged row by row; an empty table gives no rows.  Texts of any length
are judged whole: repeated windows are found by sorting the text's window
hashes, so the work of a long text is n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names

SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

#: Frequent function words by language.
STOP_WORDS = {
    "en": "the of and to in a is that for with on as be was this by an not are it from at or",
    "de": "der die und das den von zu mit auf ist im für ein eine nicht sich des dem",
    "fr": "le la les de des et un une à du que pour dans est en par sur au il",
    "es": "el la los las de que y en un una por con del se su para es lo",
}

#: Words under this number, or repeated words over this percentage, fail the base.
MIN_WORDS, MAX_REPEATED = 50, 50

#: (rule, metric, comparison, percent, other metric): the rule fails when
#: 100 * metric <comparison> percent * other metric.
RULES = [
    ("short_words", "word_chars", "<", 300, "n_words"),
    ("long_words", "word_chars", ">", 1000, "n_words"),
    ("symbols", "n_symbols", ">", 10, "n_words"),
    ("few_stop_words", "n_stop_words", "<", 6, "n_words"),
    ("few_letters", "n_letters", "<", 60, "word_chars"),
    ("repeated_lines", "n_dup_lines", ">", 50, "n_lines"),
    ("bullet_lines", "n_bullet_lines", ">", 90, "n_lines"),
    ("cut_lines", "n_cut_lines", ">", 30, "n_lines"),
]

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_stop_words", "n_letters", "n_lines", "n_bullet_lines", "n_cut_lines")


def stop_words() -> list[str]:
    return sorted({w for words in STOP_WORDS.values() for w in words.split()})


def _long(c: Column) -> Column:
    return c.cast("long")


def _repeat_words(n: Column, windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Sorted by (hash, place), a repeated window has an equal neighbour; then
    each covered stretch is counted by the gaps between their places."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(sorted_windows: Column) -> Column:
        def equal(x, i):
            return F.coalesce(F.get(sorted_windows, i)["h"] == x["h"], F.lit(False))
        found = F.filter(sorted_windows, lambda x, i: equal(x, i - 1) | equal(x, i + 1))
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    # one-element arrays bind an intermediate result to a lambda variable, so it
    # is computed once and not once for each mention
    by_window = F.transform(F.array(ordered), repeated)
    total = F.get(F.transform(by_window, covered), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(total)


def measured(documents: DataFrame, prefix: str = "__q_") -> DataFrame:
    """``documents`` plus one column ``prefix + metric`` for each metric."""
    p = prefix
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    one = documents.withColumns({p + "words": words, p + "lines": lines})
    # hashes of the words, then of the windows of three
    two = one.withColumn(p + "h", F.transform(p + "words", lambda x: F.xxhash64(x)))
    starts = F.slice(p + "h", F.lit(1), F.greatest(F.size(p + "h") - 2, F.lit(0)))
    windows = F.transform(starts, lambda x, i: F.xxhash64(x, F.get(F.col(p + "h"), i + 1), F.get(F.col(p + "h"), i + 2)))
    three = two.withColumn(p + "w", windows)
    n = F.size(p + "words")
    found = three.withColumns({
        p + "n_words": _long(n),
        p + "word_chars": _long(F.length(F.array_join(p + "words", ""))),
        p + "n_symbols": _long(F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))),
        p + "n_dup_lines": _long(F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))),
        p + "n_repeat_words": _long(_repeat_words(n, F.col(p + "w"))),
        p + "n_stop_words": _long(F.size(F.filter(p + "words", lambda x: F.lower(x).isin(stop_words())))),
        p + "n_letters": _long(F.length(F.regexp_replace(text, r"\P{L}+", ""))),
        p + "n_lines": _long(F.size(p + "lines")),
        p + "n_bullet_lines": _long(F.size(F.filter(p + "lines", lambda x: x.rlike(r"^[\x20\x09]*[-*•]")))),
        p + "n_cut_lines": _long(F.size(F.filter(p + "lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$")))),
    })
    return found.drop(p + "words", p + "lines", p + "h", p + "w")


def compile_rules(prefix: str = "__q_", rules=None) -> tuple[Column, dict[str, Column]]:
    """(base_failed, {rule: failed}) as columns over the metrics."""
    def m(name):
        return F.col(prefix + name)
    base = (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > MAX_REPEATED * m("n_words"))
    failed = {}
    for name, metric, comparison, percent, other in RULES if rules is None else rules:
        left, right = 100 * m(metric), percent * m(other)
        failed[name] = left < right if comparison == "<" else left > right
    return base, failed


def _verdict(prefix: str) -> tuple[Column, Column, Column]:
    base, failed = compile_rules(prefix)
    names = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in failed.items()])), ",")
    any_failed = base
    for c in failed.values():
        any_failed = any_failed | c
    return base, ~any_failed, names


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """doc_id, the metrics, base_failed, kept, failed_rules of every row."""
    base, kept, names = _verdict("__q_")
    rows = measured(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.select("doc_id", *[F.col("__q_" + m).alias(m) for m in METRICS],
                       base.alias("base_failed"), kept.alias("kept"), names.alias("failed_rules"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that pass, with their own columns unchanged."""
    _, kept, _ = _verdict("__q_")
    docs, back = own_names(documents)
    # a filter isn't moved below a projection that numbers rows; moved there, the
    # optimizer would repeat all metrics inside the condition
    judged = measured(docs).withColumns({"__q_kept": kept, "__q_row": F.monotonically_increasing_id()})
    return back(judged.where(F.col("__q_kept") & (F.col("__q_row") >= 0)))


def oracle() -> str:
    """The same in DuckDB SQL, over the table ``documents``."""
    stops = ", ".join("'" + w + "'" for w in stop_words())
    tests = [f"(100 * {a} {op} {k} * {b})" for _, a, op, k, b in RULES]
    names = ", ".join(f"CASE WHEN {t} THEN '{n}' END" for (n, *_), t in zip(RULES, tests, strict=True))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t,
         list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT rid, unnest(range(len(ws) - 2)) AS p,
         unnest(list_transform(range(len(ws) - 2), lambda i: ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) AS win
  FROM w WHERE len(ws) >= 3
), r AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS c FROM g
), cov AS (
  SELECT rid, count(DISTINCT q) AS n FROM (
    SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM r WHERE c > 1) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(list_aggregate(ws, 'string_agg', '')) AS BIGINT) AS word_chars_,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words,
    CAST(length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS BIGINT) AS n_letters,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS BIGINT) AS n_cut_lines
  FROM w LEFT JOIN cov ON w.rid = cov.rid
), v AS (
  SELECT *, coalesce(word_chars_, 0) AS word_chars,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m
)
SELECT doc_id, {", ".join(METRICS)}, base_failed,
       NOT (base_failed OR {" OR ".join(tests)}) AS kept,
       concat_ws(',', {names}) AS failed_rules
FROM v"""
