"""op5: near-duplicate groups by bottom-k sketches from one hash function.

1. A document's set: distinct ``words``-word shingles of its lower-cased (A-Z)
   words; with fewer words the whole sequence as one.  Every shingle has one
   64-bit hash; the sketch is the ``SKETCH`` smallest hashes of the set.
2. Documents with the same set are one class from here on (thousands of exact
   copies cost one row).
3. Inverted lists of the ``LISTED`` smallest hashes.  Two sets of similarity 0.8
   share nearly all of those, so a pair must share at least ``SHARED`` of them.
   The shared values are fewest where one set contains the other (a truncated
   copy): Binomial(LISTED, 0.8) for long texts, under ``SHARED`` with a chance of
   2e-7.  Then both hold a common value among
   the rarest LISTED - SHARED + 1 of their values, and only those make
   candidates.  A passage that many unrelated documents quote is
   frequent, hence not among a document's rarest values.
4. Members of a list of up to SHORT_LIST meet each other.  Those of a longer list
   meet its pivot only, the member whose values are most frequent (the centre of
   a group of near copies).
5. The union-sketch estimate of a pair's similarity drops pairs that are far
   below the threshold; the others are decided on their full sets.
6. Members of a long list that are not joined with its pivot may still be linked
   with others.  Such pairs share about half of their differences from the
   pivot's set, and a prefix filter on those differences finds them all without
   meeting everyone (``_odd_pairs``).  Nothing is capped.
7. Components of the links; the smallest doc_id of each is kept.

Null text and text without words: an empty set, linked with nothing.  Null
doc_ids take part; a component's id is the smallest non-null doc_id, and a
row without doc_id is kept only if it is linked with nothing.  Rows that repeat
a doc_id all get its result.  Empty tables give empty results; other columns
are not read.  Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names, release, row_key, sub_batches, written
from .components import components

WORDS, THRESHOLD = 5, 80
SKETCH, LISTED, SHARED = 64, 40, 18
#: An estimate under this share of the union sketch rules a pair out: at
#: similarity 0.8 the estimate falls below it with a chance under 1e-8.
LEAST_ESTIMATE = 0.5
#: Lists up to this size meet in full; longer ones meet pivots.
SHORT_LIST = 12

#: Words whose hash a task remembers.
_WORD_HASHES = 300_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class _Hashes(dict):
    """word -> 64-bit hash; bounded, first seen stay."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORD_HASHES:
            self[word] = h
        return h


_hashes = _Hashes()


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text (UTF-8).

    bytes.lower and split touch ASCII only, as the definition asks."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    n = len(parts) - width + 1
    mixed = np.full(n, np.uint64(width))
    for k in range(width):
        mixed = (mixed ^ h[k:k + n]) * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    if n > 1:
        mixed = mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]
    return mixed


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sub_batches(batch, 2):
                sizes, digests, sketches = [], [], []
                for text in piece.column(2).cast(pa.binary()).to_pylist():
                    hashes = shingle_hashes(text, words)
                    sizes.append(hashes.size)
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    sketches.append(hashes[:SKETCH])
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                ends = np.cumsum([0] + [len(x) for x in sketches]).astype(np.int32)
                flat = np.concatenate(sketches).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(sizes, pa.int64()),
                     pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc", "tx", "n", "s1", "s2", "sketch"])
        _hashes.clear()
        release()
    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sub_batches(batch, 1):
                sets = [shingle_hashes(t, words) for t in piece.column(1).cast(pa.binary()).to_pylist()]
                ends = np.cumsum([0] + [len(x) for x in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "hashes"])
        _hashes.clear()
        release()
    return run


def _signed_order(column: str):
    """Sketch values are unsigned; flip the sign bit so that array_sort's order is theirs."""
    return F.transform(column, lambda x: x.bitwiseXOR(F.lit(-2**63)))


def _members(classes: DataFrame) -> DataFrame:
    """(v, node, n, score): rows of the inverted lists that make candidates."""
    listed = classes.select("node", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("v"))
    counts = listed.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = (listed.join(counts, "v").groupBy("node", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))
    need = F.ceil(F.least(F.col("n"), F.lit(LISTED)) * (SHARED / LISTED)).cast("int")
    rare = (shared.where(F.size("vs") >= need)
            .select("node", "n", F.aggregate("vs", F.lit(0).cast("long"), lambda s, x: s + x["df"]).alias("score"),
                    F.explode(F.slice("vs", F.lit(1), F.size("vs") - need + 1)).alias("x")))
    return rare.select(F.col("x.v").alias("v"), "node", "n", "score")


def _near_size(a: str, b: str):
    """Similarity 0.8 needs sizes within a factor of 0.8."""
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sketches = classes.select("node", _signed_order("sketch").alias("s"))
    both = (pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    common = F.array_intersect(F.array_intersect("sa", "sb"), union)
    return both.where(F.size(common) >= LEAST_ESTIMATE * F.size(union)).select("a", "b")


def _sets_of(nodes: DataFrame, classes: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """(node, hashes): the full sets of some classes, from one text of each."""
    holders = classes.join(nodes, "node", "left_semi").select("node", F.col("doc").alias("d"), F.col("tx").alias("t"))
    texts = documents.select(*row_key(), F.col("text").cast("string").alias("text"))
    held = (texts.join(holders, F.col("__doc").eqNullSafe(F.col("d")) & (F.col("__tx") == F.col("t")))
            .select("node", "text"))
    return written(held.dropDuplicates(["node"]).mapInArrow(_full_sets(words), "node long, hashes array<long>"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
    inter = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - inter
    return both.where(100 * inter >= THRESHOLD * union).select("a", "b")


def _first_pairs(lists: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members of short lists meet each other, those of long lists their pivot."""
    left = lists.select("v", "m", F.col("node").alias("x"), F.col("n").alias("nx"))
    right = lists.where(_short()).select("v", F.col("node").alias("p"), F.col("n").alias("np"))
    short = left.where(_short()).join(right, "v").where("x < p")
    long = left.where(~_short()).join(pivots, "v").where("x <> p")
    met = short.select("x", "p", "nx", "np").unionByName(long.select("x", "p", "nx", "np")).where(_near_size("nx", "np"))
    return met.select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b")).distinct()


def _short():
    return F.col("m") <= SHORT_LIST


def _merged(comps: DataFrame, found: DataFrame) -> DataFrame:
    """Components after more links: the links join old components."""
    ends = (found.join(comps.toDF("a", "ca"), "a", "left").join(comps.toDF("b", "cb"), "b", "left")
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    merged = components(ends).toDF("comp", "into")
    kept = comps.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp"))
    new = merged.toDF("node", "comp").join(comps.select("node"), "node", "left_anti")
    return written(kept.unionByName(new), "comps")


def _odd_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that may still be linked in the groups around a pivot.

    ``members``: (p, node, comp, pc), the members of all long lists of pivot p that
    hold several components.  With E(z) the symmetric difference of z's set and the
    pivot's, two members are linked only if

        2 |E(x) & E(y)| >= |E(x)| + |E(y)| - (n(x) + n(y)) / 9,

    and for a member x outside the pivot's component |E(x)| > (n(x) + n(p)) / 9, so
    x and y must share about half of y's few differences.  Both sides keep just
    so many of their rarest differences that a pair above the bound shares one.
    """
    held = sets.toDF("node", "hz")
    pivot = sets.toDF("p", "hp")
    both = members.join(held, "node").join(pivot, "p")
    diff = F.concat(F.array_except("hz", "hp"), F.array_except("hp", "hz"))
    each = both.select("p", "node", "comp", (F.col("comp") != F.col("pc")).alias("odd"), F.size("hz").alias("n"), diff.alias("diff"))
    each = written(each.withColumn("e", F.size("diff")), "differences")
    # one row a pivot
    bounds = each.where("node <> p").groupBy("p").agg(
        F.min("e").alias("least"), F.min(F.when(F.col("odd"), F.col("e"))).alias("least_odd"), F.max("n").alias("most"))
    each = each.where("node <> p").join(bounds, "p")
    t_x = F.ceil((F.col("e") + F.col("least") - (F.col("n") + F.col("most")) / 9) / 2)
    t_y = F.ceil((F.col("e") + F.col("least_odd") - (F.col("n") + F.col("most")) / 9) / 2)
    each = each.withColumns({"tx": F.greatest(t_x, F.lit(1)).cast("int"), "ty": F.greatest(t_y, F.lit(1)).cast("int")})
    elements = each.select("p", "node", F.explode("diff").alias("d"))
    counts = elements.groupBy("p", "d").agg(F.count("*").alias("df")).where("df > 1")
    shared = (elements.join(counts, ["p", "d"]).groupBy("p", "node")
              .agg(F.sort_array(F.collect_list(F.struct("df", "d"))).alias("ds")))
    sides = written(each.drop("diff", "least", "least_odd", "most").join(shared, ["p", "node"]), "shared-differences")

    def rarest(t: str) -> DataFrame:
        """The rarest differences, each with its rank among all of the member's (those
        that nobody shares come first)."""
        prefix = F.slice("ds", F.lit(1), F.size("ds") - F.col(t) + 1)
        rows = sides.where(F.size("ds") >= F.col(t)).select("*", F.posexplode(prefix).alias("i", "el"))
        return rows.withColumns({"rank": F.col("e") - F.size("ds") + F.col("i") + 1, "d": F.col("el.d")})
    x = rarest("tx").where("odd").select("p", "d", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("e").alias("ex"),
                                         F.col("comp").alias("cx"), F.col("rank").alias("rx"))
    y = rarest("ty").select("p", "d", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("e").alias("ey"),
                            F.col("comp").alias("cy"), F.col("rank").alias("ry"))
    # the pair's own bound: a shared difference must be among its first few on both sides
    need = F.ceil((F.col("ex") + F.col("ey") - (F.col("nx") + F.col("ny")) / 9) / 2)
    near = (F.col("cx") != F.col("cy")) & _near_size("nx", "ny") & (F.col("rx") <= F.col("ex") - need + 1) & (F.col("ry") <= F.col("ey") - need + 1)
    met = x.alias("x").join(y.alias("y"), (F.col("x.p") == F.col("y.p")) & (F.col("x.d") == F.col("y.d")) & near)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def link_classes(classes: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """(node, comp) of all classes that are linked with another class."""
    members = _members(classes)
    sizes = members.groupBy("v").agg(F.count("*").alias("m"), F.max(F.struct("score", "node", "n")).alias("top")).where("m > 1")
    lists = written(members.join(sizes.select("v", "m"), "v"), "lists")
    # the centre of a long list: the member whose sketch values are most frequent
    pivots = written(sizes.where(~_short()).select("v", F.col("top.node").alias("p"), F.col("top.n").alias("np")), "pivots")
    sets = _sets_of(lists.select("node").distinct(), classes, documents, words)
    pairs = written(_first_pairs(lists, pivots), "pairs")
    likely = written(_estimated(pairs, classes), "likely")
    comps = components(written(_verified(likely, sets), "links"))
    # members of long lists by pivot, where several components are left
    labels = lists.where(~_short()).join(pivots, "v").select("p", "node").distinct().join(comps, "node", "left")
    labels = labels.select("p", "node", F.coalesce("comp", "node").alias("comp"))
    around = (labels.groupBy("p").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.max(F.when(F.col("node") == F.col("p"), F.col("comp"))).alias("pc"))
              .where("lo < hi").select("p", "pc"))
    left = written(labels.join(around, "p"), "members")
    rest = written(_odd_pairs(left, sets), "pairs")
    found = written(_verified(rest, sets), "links")
    return comps if found.isEmpty() else _merged(comps, found)


def grouped_rows(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc, tx (the row key), n_shingles, component_id, kept."""
    rows = documents.select(*row_key(), F.col("text").cast("string").alias("text"))
    sets = written(rows.mapInArrow(_sketch(words), "doc long, tx long, n long, s1 long, s2 long, sketch array<long>"), "sketches")
    # one class for each distinct set; its smallest document stands for it
    classes = (sets.where("n > 0").groupBy("s1", "s2")
               .agg(F.min(F.struct("doc", "tx")).alias("rep"), F.min("doc").alias("low"), F.first("n").alias("n"),
                    F.first("sketch").alias("sketch"))
               .select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "n", "low",
                       F.col("rep.doc").alias("doc"), F.col("rep.tx").alias("tx"), "sketch"))
    classes = written(classes, "classes")
    comps = link_classes(classes, documents, words)
    named = classes.select("node", "s1", "s2", "low").join(comps, "node", "left")
    lowest = named.where("comp is not null").groupBy("comp").agg(F.min("low").alias("lowest"))
    names = (named.join(lowest, "comp", "left")
             .select("s1", "s2", F.coalesce("lowest", "low").alias("component"),
                     F.col("comp").isNotNull().alias("linked")))
    out = sets.drop("sketch").join(names, ["s1", "s2"], "left")
    # a set of one's own: the row itself; an empty set: linked with nothing
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc"))
    copies = F.col("linked") | F.col("component").isNotNull()
    kept = F.when(F.col("doc").isNotNull(), F.col("doc") == component).otherwise(
        (F.col("n") == 0) | ~F.coalesce(copies, F.lit(False)))
    return out.select("doc", "tx", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def near_duplicates(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    return grouped_rows(documents, words).select(F.col("doc").alias("doc_id"), "n_shingles", "component_id", "kept")


def keep_first(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``documents`` that are kept, with their own columns unchanged."""
    docs, back = own_names(documents)
    gone = grouped_rows(docs, words).where(~F.col("kept")).select(F.col("doc").alias("__gdoc"), F.col("tx").alias("__gtx")).distinct()
    key_doc, key_tx = row_key()
    keyed = docs.withColumns({"__doc": key_doc, "__tx": key_tx})
    on = keyed["__doc"].eqNullSafe(gone["__gdoc"]) & (keyed["__tx"] == gone["__gtx"])
    return back(keyed.join(gone, on, "left_anti"))
