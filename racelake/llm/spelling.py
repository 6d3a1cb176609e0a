"""op12: groups of spelling variants by PartEnum signatures of letter multisets.

A word's letters with their repeats form a binary vector: one dimension for each (letter,
occurrence).  One inserted or deleted letter changes one dimension, one replaced letter
two, so near words are at Hamming distance two at most.  Dimensions are hashed into
``PARTS`` parts; two vectors that differ in two dimensions agree on at least ``PARTS`` - 2
parts, so the words agree on at least one way to choose that many parts.  Each word emits
a signature for each choice, for its own length and for the next shorter one.  Besides,
an edit leaves the front or the back half of the shorter word untouched; that half is
part of the signature.  Signatures meet in an equi-join, and Levenshtein's distance
verifies each meeting inside the join, so only near pairs leave it.

A signature that more than ``HOT`` words share is dealt exactly in another way: its words
are joined by equal patterns (one letter blanked or left out), and one pattern can only
hold about as many words as there are letters.  So no group is compared all with all.

Counting comes first: runs are changed and counted where they stand, partial sums go
over the network; everything after works on distinct words.

Results.  Null and empty text has no words; a null doc_id counts as empty text in the
checksum.  Ties for the form: the smallest word in code-point order.  Repeated rows count
again.  Words and texts of any length are used whole.  Empty tables, or no word that is
frequent enough: no rows.  Other columns are not read.
"""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_CHARS, MIN_COUNT = 5, 3
#: A run is changed where its checksum is a multiple of this.
CHANGED = 97
#: Parts of the vector, and the Hamming distance that signatures must survive.
PARTS, DISTANCE = 4, 2
#: Words of a signature that are still compared with each other.
HOT = 256


def word_counts(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the (changed) runs of all documents that are long and frequent enough."""
    text = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                            F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % CHANGED == 0, cut).otherwise(F.col("run"))
    return (runs.where(F.length("run") >= min_chars).withColumn("h", h).select(word.alias("word"))
            .where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def signatures(word: Column, parts: int = PARTS, distance: int = DISTANCE) -> Column:
    """One 64-bit signature for each choice of ``parts - distance`` parts of the letter vector."""
    letters = F.array_sort(F.filter(F.split(word, ""), lambda c: c != ""))
    # equal letters stand together once sorted, so a letter's occurrence is its distance from the first
    dims = F.transform(F.array(letters), lambda a: F.transform(a, lambda c, i: F.struct(
        c.alias("c"), F.pmod(F.xxhash64(c, i - F.array_position(a, c).cast("int")), F.lit(parts)).alias("part"))))

    def chosen(ds: Column, keep: tuple[int, ...]) -> Column:
        held = F.transform(F.filter(ds, lambda d: d["part"].isin(*keep)), lambda d: d["c"])
        return F.xxhash64(F.lit(",".join(map(str, keep))), F.array_join(held, ""))
    return F.get(F.transform(dims, lambda ds: F.array(*[chosen(ds, k) for k in combinations(range(parts), parts - distance)])), 0)


def _keys(words: DataFrame) -> DataFrame:
    """(key, word, n, longer): every signature of every word, for both lengths and halves.

    ``longer``: the word stands for one letter more than the length in the key."""
    size = F.length("word")
    signed = words.select("word", "n", signatures(F.col("word")).alias("signatures"))
    sides = [F.struct(F.lit(longer).alias("longer"), (size - int(longer)).alias("size")) for longer in (False, True)]
    sized = signed.select("word", "n", "signatures", F.inline(F.array(*sides)))
    front = F.floor(F.col("size") / 2).cast("int")
    back = F.col("size") - front
    halves = F.array(F.struct(F.lit(0).alias("half"), F.substring(F.col("word"), F.lit(1), front).alias("part")),
                     F.struct(F.lit(1).alias("half"), F.substring(F.col("word"), size - back + 1, back).alias("part")))
    halved = sized.select("word", "n", "longer", "size", "signatures", F.inline(halves))
    return (halved.select("word", "n", "longer", "size", "half", "part", F.explode("signatures").alias("signature"))
            .select(F.xxhash64("size", "half", "part", "signature").alias("key"), "word", "n", "longer"))


def _meet(rows: DataFrame, on: list[str]) -> DataFrame:
    """Verified near pairs among rows that agree in ``on``; the first is never the longer one."""
    left = rows.where(~F.col("longer")).select(*on, F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = rows.select(*on, F.col("word").alias("b"), F.col("n").alias("b_n"), "longer")
    both = left.join(right, on).where((F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return both.select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """a, a_n, b, b_n: every pair of words at one edit, once."""
    keys = written(_keys(words), "signatures")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    sizes = written(sizes.select("key", (F.col("size") > hot).alias("hot")), "signature-sizes")
    few = keys.join(sizes.where(~F.col("hot")).select("key"), "key", "left_semi")
    many = keys.join(sizes.where("hot").select("key"), "key", "left_semi")
    # words of equal length agree but for one blanked place; a longer one without one letter is the shorter
    places = F.sequence(F.lit(1), F.length("word"))

    def without(filler: str):
        return F.transform(places, lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1), F.lit(filler),
                                                      F.substring(F.col("word"), i + 1, F.length("word"))))
    patterns = F.when(F.col("longer"), F.array_distinct(without(""))).otherwise(F.concat(without("_"), F.array("word")))
    patterned = many.select("key", "word", "n", "longer", F.explode(patterns).alias("pattern"))
    found = _meet(few, ["key"]).unionByName(_meet(patterned, ["key", "pattern"]))
    return found.distinct()


def spelling_groups(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every distinct word.

    form: the most frequent near word, if at least twice as frequent; root: the last
    word on the way from form to form (the word itself without one)."""
    words = written(word_counts(documents, min_chars, min_count), "words")
    pairs = written(near_pairs(words, hot), "near-pairs")
    to = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    best = to.unionByName(back).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    often = -F.col("best.less") >= 2 * F.col("n")
    forms = written(words.join(best, "word", "left").select(
        "word", F.when(often, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n")), "forms")
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root.  Each round takes every word one form further: the join key is a form,
    which has only its near words, so no key gets hot.  Counts at least double at each
    step, hence no circles and few rounds."""
    roots = forms.select("word", F.col("word").alias("root"))
    steps = forms.where("form is not null").select("word", "form")
    while True:
        further = steps.join(roots.select(F.col("word").alias("form"), "root"), "form").select("word", "root")
        done = roots.join(steps, "word", "left_anti")
        found = written(further.unionByName(done), "roots")
        changed = found.join(roots, ["word", "root"], "left_anti").limit(1).count()
        roots = found
        if not changed:
            return roots
