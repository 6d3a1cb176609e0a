"""op7: personal data by patterns, and terms that disclose it by co-occurrence.

Only DataFrame functions.  Base spans: e-mail, IP, card and phone patterns,
leftmost and non-overlapping per kind; a match that fails its check is dropped.
Splitting a text by a pattern gives the gaps between the matches; start
offsets are running sums over gaps and matches, so a text is scanned a fixed
number of times however many matches it holds.  The patterns are possessive and
start at the beginning of a run, so no text makes them back-track for long.

Terms: each base span protects an entity (its normalised value).  Over the
corpus, with N documents,

    information of an entity   IC(e)     = log2(N / df(e))
    what a term tells of it    PMI(e; t) = log2(p(e | t) * N / df(e))

where p(e | t) = (co(e, t) + ``PRIOR`` * df(e) / N) / (df(t) + ``PRIOR``), the share
of the term's documents that hold the entity, drawn to the entity's own share as
by ``PRIOR`` more documents: few documents count for less, and none are too few.
co counts documents with both, wherever they stand, and df(t) documents with the
term anywhere.  PMI / IC nears 1 if the term occurs with that entity alone.
A pair is looked at if its term stands within ``WINDOW`` code points of the entity at
``SIGHTINGS`` places or more (across lines and other matches), in one document or several:
what was seen together once tells nothing.  Terms with a share of at least ``REMOVE`` are
removed, those of at least ``GENERALISE`` become a placeholder, wherever they stand in a
document that holds the entity.  A term is a run of three or more letters outside the base
spans, so added spans (kind ``term``) never overlap those.

Null text is empty: no spans.  Every row of repeated rows has its own result.
Null doc_ids stay.  An empty table gives no rows.  Other columns pass through
``sanitise`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_names, written

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW, SIGHTINGS, PRIOR, REMOVE, GENERALISE = 48, 2, 5, 0.9, 0.6
#: Entities times terms of a text up to which all its pairs are counted at once.
_PAIRS = 200_000

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Patterns, and a cheap test that every text with a match passes.  Each agrees
#: with the plain pattern of its kind: possessive runs lose nothing as what follows
#: a run can't be part of it, and a start inside a run fails as its beginning did.
PATTERNS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_OK = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
_RUNS = r"\p{L}+|\P{L}+"
_TERM = r"^\p{L}{3}"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, less 9 from 10 on."""
    back = F.reverse(digits)

    def weigh(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, weigh), F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(_IP_OK)
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _entity(kind: str, m: Column) -> Column:
    value = F.lower(m) if kind == "email" else m if kind == "ip" else _digits(m)
    return F.concat(F.lit(kind + ":"), value)


_HITS = "array<struct<kind:int,place:int,gap:int,size:int,ok:boolean,entity:string>>"


def _hit(number: int, kind: str):
    gaps = F.col(f"__gaps_{kind}")

    def make(m: Column, i: Column) -> Column:
        ok = _valid(kind, m)
        return F.struct(F.lit(number).alias("kind"), i.alias("place"), F.length(F.get(gaps, i)).alias("gap"),
                        F.length(m).alias("size"), ok.alias("ok"), F.when(ok, _entity(kind, m)).alias("entity"))
    return make


def _hits(documents: DataFrame) -> DataFrame:
    """``documents`` plus __rid (row number) and __hits, all matches of each kind:
    (kind, place, gap before, length, valid, entity)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.withColumns({"__rid": F.monotonically_increasing_id(), "__text": text})
    none = F.lit(None).cast("array<string>")
    for kind, (pattern, test) in PATTERNS.items():
        maybe = F.col("__text").contains("@") if kind == "email" else F.col("__text").rlike(test)
        rows = rows.withColumn("__may", maybe).withColumns({
            f"__gaps_{kind}": F.when(F.col("__may"), F.split("__text", pattern, -1)).otherwise(none),
            f"__found_{kind}": F.when(F.col("__may"), F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(none)})
    lists = [F.coalesce(F.transform(f"__found_{kind}", _hit(number, kind)), F.array().cast(_HITS))
             for number, kind in enumerate(PATTERNS)]
    drop = [f"__{x}_{k}" for k in PATTERNS for x in ("gaps", "found")]
    return rows.withColumn("__hits", F.concat(*lists)).drop("__text", "__may", *drop)


def _occurrences(hits: DataFrame) -> DataFrame:
    """Valid matches with offsets: (rid, kind, start, stop, entity)."""
    each = hits.select(F.col("__rid").alias("rid"), F.explode("__hits").alias("h")).select("rid", "h.*")
    so_far = Window.partitionBy("rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far)
    return (each.withColumn("stop", stop).where("ok")
            .select("rid", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop", "entity"))


def _merged(spans: DataFrame, *more: Column) -> DataFrame:
    """(rid, start, stop, *more): overlapping spans of different kinds become one."""
    order = Window.partitionBy("rid").orderBy("start", "kind", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")
    return (spans.withColumn("opens", opens)
            .withColumn("g", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("rid", "g").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), *more).drop("g"))


def _replaced(text: Column, spans: Column) -> Column:
    """A text with each of its spans (start, stop, label) replaced by the label."""
    def piece(x, i):
        since = F.coalesce(F.get(spans, i - 1)["stop"], F.lit(0))
        return F.concat(F.substring(text, (since + 1).cast("int"), (x["start"] - since).cast("int")), x["label"])
    tail = F.substring(text, (F.element_at(spans, -1)["stop"] + 1).cast("int"), F.length(text))
    return F.concat(F.array_join(F.transform(spans, piece), ""), tail)


def _terms(hits: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(rid, term, start, stop) of the letter runs outside base spans, of the texts
    that hold any."""
    blank = F.expr("repeat(' ', cast(stop - start as int))").alias("label")
    lists = (_merged(occurrences).groupBy("rid")
             .agg(F.sort_array(F.collect_list(F.struct("start", "stop", blank))).alias("spans")))
    texts = hits.where(F.exists("__hits", lambda h: h["ok"])).select(F.col("__rid").alias("rid"), "text").join(lists, "rid")
    runs = texts.select("rid", F.regexp_extract_all(_replaced(F.col("text"), F.col("spans")), F.lit(_RUNS), F.lit(0)).alias("runs"))
    each = runs.select("rid", F.posexplode("runs").alias("i", "run"))
    so_far = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("stop", F.sum(F.length("run").cast("long")).over(so_far)).where(F.col("run").rlike(_TERM))
    return placed.select("rid", F.lower("run").alias("term"), (F.col("stop") - F.length("run")).alias("start"), "stop")


def _near_terms(terms: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(rid, entity, term, start, stop) of the terms within WINDOW of an occurrence."""
    lo, hi = F.col("start") - WINDOW, F.col("stop") + WINDOW
    cells = F.sequence(F.floor(lo / WINDOW), F.floor(hi / WINDOW))
    around = occurrences.select("rid", "entity", lo.alias("lo"), hi.alias("hi"), F.explode(cells).alias("cell"))
    met = terms.withColumn("cell", F.floor(F.col("start") / WINDOW)).join(around, ["rid", "cell"])
    return met.where("start >= lo and stop <= hi").select("rid", "entity", "term", "start", "stop").distinct()


def _holders(occurrences: DataFrame) -> DataFrame:
    return occurrences.select("rid", "entity").distinct().groupBy("entity").agg(F.count("*").alias("df_e"))


def _together(near: DataFrame, terms: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(entity, term, co): the documents with both, of the pairs that are near each
    other at enough places: one for the entities of one document.  For others all pairs
    of a text are counted at once, before the shuffle; a text of very many gives the
    wanted ones only."""
    df_e = _holders(occurrences)
    wanted = near.groupBy("entity", "term").agg(F.count("*").alias("seen")).where(F.col("seen") >= SIGHTINGS).drop("seen")
    alone = wanted.join(df_e.where("df_e = 1"), "entity").select("entity", "term", F.lit(1).cast("long").alias("co"))
    held = occurrences.join(df_e.where("df_e > 1"), "entity").groupBy("rid").agg(F.collect_set("entity").alias("es"))
    words = terms.join(held.select("rid"), "rid", "left_semi").groupBy("rid").agg(F.collect_set("term").alias("ts"))
    texts = written(held.join(words, "rid"), "pii-texts")
    many = F.size("es").cast("long") * F.size("ts") > _PAIRS
    few = texts.where(~many).select(F.explode("es").alias("entity"), "ts").select("entity", F.explode("ts").alias("term"))
    few = few.groupBy("entity", "term").agg(F.count("*").alias("co"))
    few = few.join(wanted, ["entity", "term"])
    large = texts.where(many)
    pairs = large.select("rid", F.explode("es").alias("entity")).join(wanted, "entity")
    rest = pairs.join(large.select("rid", F.explode("ts").alias("term")), ["rid", "term"])
    rest = rest.groupBy("entity", "term").agg(F.count("*").alias("co"))
    return alone.unionByName(few.unionByName(rest).groupBy("entity", "term").agg(F.sum("co").alias("co")))


def _disclosing(co: DataFrame, occurrences: DataFrame, documents: DataFrame) -> DataFrame:
    """(entity, term, share) of the pairs above the lower threshold."""
    co = written(co, "pii-pairs")
    wanted = co.select("term").distinct()
    df_e = _holders(occurrences)
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\P{L}+"))
    counted = documents.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    df_t = counted.join(wanted, "term")  # an inner join: a semi join would be moved below the counting
    # N as a one-row scalar
    total = documents.count()
    n = F.lit(float(total))
    facts = co.join(df_e, "entity").join(df_t, "term")
    given = (F.col("co") + PRIOR * F.col("df_e") / n) / (F.col("df_t") + PRIOR)
    pmi = F.log2(given * n / F.col("df_e"))
    ic = F.log2(n / F.col("df_e"))
    share = F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))
    return facts.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def _everywhere(pairs: DataFrame, terms: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(rid, start, stop, share): every place of a disclosing term in the documents that
    hold its entity.  A text of very many entities and terms starts from the pairs, so
    that no text is multiplied out."""
    held = occurrences.select("rid", "entity").distinct().join(pairs.select("entity").distinct(), "entity", "left_semi")
    said = terms.join(pairs.select("term").distinct(), "term", "left_semi")
    sizes = (held.groupBy("rid").agg(F.count("*").alias("es")).join(said.groupBy("rid").agg(F.count("*").alias("ts")), "rid"))
    large = sizes.where(F.col("es") * F.col("ts") > _PAIRS).select("rid")
    few = said.join(large, "rid", "left_anti").join(held, "rid").join(pairs, ["entity", "term"])
    rest = held.join(large, "rid", "left_semi").join(pairs, "entity").join(said, ["rid", "term"])
    places = few.select("rid", "start", "stop", "share").unionByName(rest.select("rid", "start", "stop", "share"))
    return places.groupBy("rid", "start", "stop").agg(F.max("share").alias("share"))


def find_spans(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """(rid, kind, start, stop, removed): base spans and, as the last kind, terms.
    ``hits`` need the text of rows with a valid match only."""
    occurrences = written(_occurrences(hits), "pii-occurrences")
    terms = written(_terms(hits, occurrences), "pii-terms")
    near = written(_near_terms(terms, occurrences), "pii-near")
    pairs = written(_disclosing(_together(near, terms, occurrences), occurrences, documents), "pii-disclosing")
    added = _everywhere(pairs, terms, occurrences).select(
        "rid", F.lit(len(PATTERNS)).alias("kind"), "start", "stop", (F.col("share") >= REMOVE).alias("removed"))
    base = occurrences.select("rid", "kind", "start", "stop", F.lit(False).alias("removed"))
    return base.unionByName(added)


def pii_spans(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    matched = F.when(F.exists("__hits", lambda h: h["ok"]), F.col("text"))
    hits = written(_hits(rows).withColumn("text", matched), "pii-hits")
    spans = find_spans(hits, rows).withColumn("s", F.struct("kind", "start", "stop")).select("rid", F.lit(None).cast("long").alias("doc_id"), "s")
    all_rows = hits.select(F.col("__rid").alias("rid"), "doc_id", F.lit(None).cast(spans.schema["s"].dataType).alias("s"))
    grouped = (all_rows.unionByName(spans).groupBy("rid")
               .agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list("s")).alias("all")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(a):
        return F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["stop"])), ",")

    def n(kind):
        return F.size(F.filter("all", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    base = F.filter("all", lambda x: x["kind"] < len(PATTERNS))
    return grouped.select("doc_id", *[n(k).alias("n_" + k) for k in PATTERNS], F.sha2(joined(base), 256).alias("base_sha256"),
                          joined(F.col("all")).alias("spans"), n("term").alias("n_terms"))


def sanitise(documents: DataFrame) -> DataFrame:
    """``documents`` with base spans as [KIND], removed terms gone and generalised
    ones as [TERM] in ``text``; same columns, same rows."""
    docs, back = own_names(documents)
    hits = written(_hits(docs), "pii-hits")
    spans = find_spans(hits, hits)
    label = F.when(F.col("removed"), "").otherwise(
        F.concat(F.lit("["), F.upper(F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))), F.lit("]")))
    # overlapping spans stand under the first one's label
    merged = _merged(spans.withColumn("label", label), F.min_by("label", F.struct("start", "kind", "stop")).alias("label"))
    lists = (merged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "label"))).alias("__spans"))
             .withColumnRenamed("rid", "__rid"))
    joined = hits.drop("__hits").join(lists, "__rid", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(_replaced(F.col("text"), F.col("__spans")))
    return back(joined.withColumn("text", text))
