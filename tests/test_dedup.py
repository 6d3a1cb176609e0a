"""Latest-version reads (K1), main session (K2), priority lookup (K3), best row (T3), any (A4)."""

import datetime as dt

from pyspark.sql import functions as F

from racelake.contract.q_ops import IDENTIFIER_SESSION_TYPES
from racelake.operators.dedup import best_row, deterministic_any, latest_by_key, main_per_group, priority_lookup
from racelake.operators.windows import ordinal
from tests.conftest import rows


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 11.0), ("b", 1, 5.0), ("b", 1, 6.0)], "k string, v int, p double")
    got = rows(latest_by_key(df, ["k"], "v", ["p"]))
    assert got == [("a", 2, 11.0), ("b", 1, 6.0)]


def _sessions(spark):
    # the reference's own season fixture: a normal weekend and a sprint weekend
    return spark.createDataFrame([
        (101, "Race", 1, "2024-03-02T15:00:00"), (102, "Qualifying", 1, "2024-03-01T15:00:00"),
        (201, "Race", 2, "2024-03-09T13:00:00"), (202, "Race", 2, "2024-03-10T15:00:00"),
        (203, "Qualifying", 2, "2024-03-09T15:00:00"),
    ], "session_key int, session_type string, meeting_key int, date_start string").withColumn(
        "date_start", F.to_timestamp("date_start"))


def test_main_session_and_round_ordinal(spark):
    s = main_per_group(_sessions(spark), ["meeting_key", "session_type"], "date_start")
    main_races = s.filter(F.col("is_main") & (F.col("session_type") == "Race")).withColumn("year", F.lit(2024))
    rounds = ordinal(main_races, ["year"], ["date_start"], "round")
    m2r = {r.meeting_key: r.round for r in rounds.collect()}
    assert sorted(m2r.values()) == [1, 2]
    idx = {(m2r[r.meeting_key], r.session_type): r.session_key
           for r in s.filter("is_main").collect() if r.meeting_key in m2r}
    assert idx[(1, "Qualifying")] == 102 and idx[(1, "Race")] == 101
    assert idx[(2, "Race")] == 202 and idx[(2, "Qualifying")] == 203


def _lookup(spark, index_rows, rnd, ident):
    opts = [(ident, o, p) for i, os_ in IDENTIFIER_SESSION_TYPES if i == ident for p, o in enumerate(os_)]
    cand = spark.createDataFrame([(rnd, i, o, p) for i, o, p in opts] or [(rnd, ident, "__none__", 0)],
                                 "round int, identifier string, option string, priority int")
    index = spark.createDataFrame(index_rows, "round int, option string, session_key int")
    got = priority_lookup(cand, index, ["round", "identifier"], ["round"], "option", "priority", ["session_key"])
    return got.first().session_key


def test_priority_lookup_reference_cases(spark):
    assert _lookup(spark, [(5, "Qualifying", 9501), (5, "Race", 9502)], 5, "Q") == 9501
    assert _lookup(spark, [(3, "Practice 1", 9301), (3, "Practice 2", 9302)], 3, "FP1") == 9301
    assert _lookup(spark, [(3, "Practice 1", 9301), (3, "Practice 2", 9302)], 3, "FP2") == 9302
    assert _lookup(spark, [(3, "Practice", 9301)], 3, "FP1") == 9301
    assert _lookup(spark, [(7, "Sprint Shootout", 9701)], 7, "SQ") == 9701
    assert _lookup(spark, [(5, "Race", 9501)], 5, "FP3") is None
    # both options present: the first in the list wins
    assert _lookup(spark, [(3, "Practice", 1), (3, "Practice 1", 2)], 3, "FP1") == 2


def test_best_row_skips_null_metric(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 90.5), (1, 3, 90.5), (2, 1, None)], "d int, lap int, t double")
    got = rows(best_row(df, ["d"], "t", ["lap"]))
    assert got == [(1, 2, 90.5)]


def test_deterministic_any_prefers_latest(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, "old", t1), (1, "new", t2), (2, "x", t1)], "k int, v string, at timestamp")
    assert rows(deterministic_any(df, ["k"], ["v"], "at")) == [(1, "new"), (2, "x")]
    assert rows(deterministic_any(df, ["k"], ["v"])) == [(1, "new"), (2, "x")]
