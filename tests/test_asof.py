"""As-of join: bound rules, NULL handling, ties, bucketed == unbucketed, brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from racelake.operators.asof import AsofRight, HotKeys, asof_join, asof_join_many, measured
from tests.conftest import rows

T0 = dt.datetime(2024, 3, 2, 14, 0, 0)


def ts(s):
    return T0 + dt.timedelta(seconds=s)


def test_inclusive_and_strict(spark):
    left = spark.createDataFrame([(1, ts(10)), (1, ts(20)), (1, ts(5)), (2, ts(10))], "k int, t timestamp")
    right = spark.createDataFrame([(1, ts(10), "a"), (1, ts(15), "b"), (2, ts(11), "c")], "k int, t timestamp, v string")
    inc = rows(asof_join(left, right, ["k"], "t", "t", ["v"]))
    assert inc == sorted([(1, ts(10), "a"), (1, ts(20), "b"), (1, ts(5), None), (2, ts(10), None)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))
    strict = {(r.k, r.t): r.v for r in asof_join(left, right, ["k"], "t", "t", ["v"], inclusive=False).collect()}
    assert strict[(1, ts(10))] is None and strict[(1, ts(20))] == "b"


def test_all_null_payload_is_a_match(spark):
    left = spark.createDataFrame([(1, ts(10))], "k int, t timestamp")
    right = spark.createDataFrame([(1, ts(1), "x"), (1, ts(5), None)], "k int, t timestamp, v string")
    # the latest right row (t=5) has v NULL: it still wins over the older 'x'
    assert asof_join(left, right, ["k"], "t", "t", ["v"]).collect()[0].v is None


def test_ties_are_deterministic(spark):
    left = spark.createDataFrame([(1, ts(10))], "k int, t timestamp")
    right = spark.createDataFrame([(1, ts(5), "a"), (1, ts(5), "z"), (1, ts(5), "m")], "k int, t timestamp, v string")
    assert asof_join(left, right, ["k"], "t", "t", ["v"]).collect()[0].v == "z"


def test_null_keys_kept_or_dropped(spark):
    left = spark.createDataFrame([(None, ts(10)), (1, None), (1, ts(10))], "k int, t timestamp")
    right = spark.createDataFrame([(1, ts(1), "a")], "k int, t timestamp, v string")
    kept = asof_join(left, right, ["k"], "t", "t", ["v"])
    assert kept.count() == 3
    assert sorted(r.v or "-" for r in kept.collect()) == ["-", "-", "a"]
    dropped = asof_join(left, right, ["k"], "t", "t", ["v"], keep_unmatchable=False)
    assert [r.v for r in dropped.collect()] == ["a"]


def _brute(left, right):
    out = []
    for k, t in left:
        best = None
        for rk, rt, v in right:
            if rk == k and rt <= t and (best is None or (rt, v) > (best[0], best[1])):
                best = (rt, v)
        out.append((k, t, None if best is None else best[1]))
    return out


def test_random_against_brute_force_and_buckets(spark):
    rnd = random.Random(7)
    left = [(rnd.randint(0, 3), ts(rnd.randint(0, 20000))) for _ in range(300)]
    right = [(rnd.randint(0, 3), ts(rnd.randint(0, 20000)), rnd.randint(0, 9)) for _ in range(200)]
    ldf = spark.createDataFrame(left, "k int, t timestamp")
    rdf = spark.createDataFrame(right, "k int, t timestamp, v int")
    want = sorted(_brute(left, right), key=str)
    got = sorted((tuple(r) for r in asof_join(ldf, rdf, ["k"], "t", "t", ["v"]).collect()), key=str)
    assert got == want
    for bucket in ("10 minutes", "1 hour", 60, HotKeys(1), HotKeys(7), HotKeys(10**6)):
        gb = sorted((tuple(r) for r in asof_join(ldf, rdf, ["k"], "t", "t", ["v"], bucket=bucket).collect()), key=str)
        assert gb == want


def test_union_equals_interval_join(spark):
    """Metamorphic: as-of by union+window == as-of by interval equi join."""
    rnd = random.Random(3)
    left = spark.createDataFrame([(rnd.randint(0, 2), ts(rnd.randint(0, 5000))) for _ in range(200)], "k int, t timestamp")
    right = spark.createDataFrame(
        [(k, ts(s), s) for k in range(3) for s in sorted(rnd.sample(range(0, 5000), 30))], "k int, t timestamp, v int")
    from pyspark.sql import Window
    iv = right.withColumn("t_end", F.lead("t").over(Window.partitionBy("k").orderBy("t")))
    j = left.join(iv.withColumnRenamed("t", "t0").withColumnRenamed("k", "k2"),
                  (F.col("k") == F.col("k2")) & (F.col("t") >= F.col("t0")) &
                  (F.col("t_end").isNull() | (F.col("t") < F.col("t_end"))), "left").select("k", "t", "v")
    assert rows(j) == rows(asof_join(left, right, ["k"], "t", "t", ["v"]))


def test_many_rights_one_pass(spark):
    left = spark.createDataFrame([(1, ts(10)), (1, ts(30))], "k int, t timestamp")
    a = spark.createDataFrame([(1, ts(0), 1), (1, ts(20), 2)], "k int, t timestamp, lap int")
    b = spark.createDataFrame([(1, ts(25), 7)], "k int, t timestamp, x int")
    got = asof_join_many(left, ["k"], "t", [AsofRight(a, "t", ["lap"]), AsofRight(b, "t", ["x"])])
    assert rows(got) == [(1, ts(10), 1, None), (1, ts(30), 2, 7)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_right_keys_and_rename(spark):
    left = spark.createDataFrame([(1, ts(10))], "car int, t timestamp")
    right = spark.createDataFrame([(1, ts(5), 7)], "driver int, at timestamp, v int")
    got = asof_join_many(left, ["car"], "t", [AsofRight(right, "at", ["v"], {"v": "value"}, by=["driver"])])
    assert got.columns == ["car", "t", "value"] and got.first().value == 7


def test_bucketed_mode_partitions_by_key_and_bucket(spark):
    """A hot key (here: the only key) is exchanged on (key, time bucket)."""
    # 3600 s sits exactly on an hour boundary: its match (3588) is carried
    # over from the previous bucket
    left = spark.createDataFrame([(1, ts(s)) for s in [*range(0, 36000, 7), 3600]], "k int, t timestamp")
    right = spark.createDataFrame([(1, ts(s), s) for s in range(0, 36000, 13)], "k int, t timestamp, v int")
    got = asof_join(left, right, ["k"], "t", "t", ["v"], bucket="1 hour")
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(k#" in plan and "__asof_b" in plan.split("hashpartitioning(k#", 1)[1].split(")")[0]
    # ten one-hour buckets of the single key -> ten window groups, exact result
    assert got.count() == left.count()
    assert {r.v for r in got.filter("t = timestamp'2024-03-02 15:00:00'").collect()} == {3588}


def test_only_hot_keys_are_cut(spark):
    """One key of 1000 rows among small ones: it alone is cut, and spread over tasks."""
    left = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), F.timestamp_seconds("id").alias("t"))
    right = spark.range(0, 1000, 50).select(F.lit(0).cast("long").alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("v"))
    got = asof_join_many(left, ["k"], "t", [AsofRight(right, "t", ["v"])], bucket=HotKeys(100),
                         keep_unmatchable=False, emit_bucket="b").collect()
    pieces = {}
    for r in got:
        pieces.setdefault((r.k, r.b), []).append(r)
        assert r.v == (r.t.timestamp() // 50 * 50 if r.k == 0 else None)
    assert {b for k, b in pieces if k == 0} == set(range(10)) | ({10} & {b for k, b in pieces if k == 0})
    assert max(map(len, pieces.values())) <= 110
    assert {b for k, b in pieces if k != 0} == {None}


def test_a_hot_key_at_one_instant(spark):
    rows_ = [(1, dt.datetime(2024, 1, 1))] * 50
    left = spark.createDataFrame(rows_, "k int, t timestamp")
    right = spark.createDataFrame([(1, dt.datetime(2023, 1, 1), 5)], "k int, t timestamp, v int")
    assert {r.v for r in asof_join(left, right, ["k"], "t", "t", ["v"], bucket=HotKeys(3)).collect()} == {5}


def test_measured(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)], "k int")
    assert measured(HotKeys(9), ["k"], [df, df]) == HotKeys(9)
    assert measured(HotKeys(10), ["k"], [df, df]) is None
    assert measured("1 hour", ["k"], [df]) == "1 hour" and measured(None, ["k"], [df]) is None
