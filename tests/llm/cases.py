"""Small tables with the defined hard cases, and plain-Python counterparts."""

import re
from collections import defaultdict

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for their own results
    T.StructField("n_words", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("start", T.StringType()),
    T.StructField("v", T.StringType()), T.StructField("node", T.StringType()), T.StructField("kind", T.StringType())])


def lower(s):
    return s.translate({i: i + 32 for i in range(65, 91)})


def prose(n, seed=0):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 100003}" for i in range(n))


def texts():
    base = prose(200, 1)
    words = base.split()
    near = [" ".join(words[:i * 9] + [f"edit{i}"] + words[i * 9 + 1:]) for i in range(20)]
    line = "A line of more than twenty code points"
    return [
        None, "", " \n\t ", "one", "two words", "a\x00b \x1c c\x85d e\xa0f", "  lead  and trail  ", "x\n\n\ny", "Ünïcödé ΑΣ ß 你好 😀 İ",
        "<|endoftext|> and <|startoftext|> in text", "don't I'LL we've", base, base, base, *near,
        f"{line}\nalpha\n{line}", f"  {line.upper()}\t\nbeta", f"{line}\ngamma", f"delta\n{line}\r",
        prose(30_000, 3), "y " * 5000, "the of and " * 400, "1" * 5000 + " " + "a" * 5000 + "@", "@." * 3000, "1.2.3.4.5.6.7.8 " * 300,
        "Write to jane@mail.example.org or +44 20 7946 0958 now\nserver 10.0.0.1 and 999.1.1.1",
        "card 4111 1111 1111 1111 and 4111 1111 1111 1112", "a@b.c+d@e.f x@y@z.com a@b_c@d.e 1 1 1 +1 1 " + "+1-2" * 900,
    ]


def documents(spark, extra=()):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", None][i % 2], None, "w", "k", "s", "v", "n", "k") for i, t in enumerate([*texts(), *extra])]
    rows.append((3, "one", "en", "s1", None, "w", "k", "s", "v", "n", "k"))   # a repeated row
    rows += [(None, t, None, None, None, None, None, None, None, None, None) for t in (None, "without an id", prose(200, 1))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def groups(rows, width):
    """Row number -> smallest row number linked with it, by brute force."""
    sets = [shingles(t, width) for _, t in rows]
    inverted = defaultdict(list)
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in inverted[x]:
                common[j] += 1
            inverted[x].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(rows))]
