"""Property-based checks (hypothesis): lap-time parsing against a pure-Python
reading of the accepted format, and the as-of join (plain and bucketed)
against brute force."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from racelake.functions.laptime import LAP_TIME_PATTERN, format_lap_time, parse_lap_time
from racelake.operators.asof import asof_join

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def py_parse(text):
    if text is None:
        return None
    m = re.fullmatch(LAP_TIME_PATTERN.strip("^$"), text.strip())
    if not m:
        return None
    mins, secs, frac = m.groups()
    return int(mins or 0) * 60000 + int(secs) * 1000 + int(frac.ljust(3, "0"))


texts = st.one_of(
    st.none(),
    st.builds(lambda m, s, f: f"{m}:{s:02d}.{f}", st.integers(0, 99), st.integers(0, 59),
              st.from_regex(r"[0-9]{1,3}", fullmatch=True)),
    st.builds(lambda s, f: f"{s}.{f}", st.integers(0, 200), st.from_regex(r"[0-9]{1,4}", fullmatch=True)),
    st.text(alphabet="0123456789:. x", max_size=12),
)


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=30))
def test_parse_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r.ms for r in df.select(parse_lap_time("t").alias("ms")).collect()]
    assert got == [py_parse(v) for v in values]


@SETTINGS
@given(st.lists(st.integers(0, 10 ** 7), min_size=1, max_size=30))
def test_format_then_parse_is_identity(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    got = [r.back for r in df.select(parse_lap_time(format_lap_time("ms")).alias("back")).collect()]
    assert got == values


T0 = dt.datetime(2024, 3, 2, 14, 0)
events = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4000)), min_size=1, max_size=40)


@SETTINGS
@given(events, st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4000), st.integers(0, 5)), max_size=40),
       st.sampled_from([None, "5 minutes", 90, "1 hour"]), st.booleans())
def test_asof_against_brute_force(spark, left, right, bucket, inclusive):
    ts = lambda s: T0 + dt.timedelta(seconds=s)
    ldf = spark.createDataFrame([(k, ts(s)) for k, s in left], "k int, t timestamp")
    rdf = spark.createDataFrame([(k, ts(s), v) for k, s, v in right], "k int, t timestamp, v int")
    got = sorted((r.k, r.t, r.v) for r in
                 asof_join(ldf, rdf, ["k"], "t", "t", ["v"], inclusive=inclusive, bucket=bucket).collect())
    want = []
    for k, s in left:
        cands = [(rs, v) for rk, rs, v in right if rk == k and (rs <= s if inclusive else rs < s)]
        want.append((k, ts(s), max(cands)[1] if cands else None))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1000, 1100)), min_size=1, max_size=6, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 2), st.integers(1, 30), st.integers(900, 1200), st.one_of(st.none(), st.integers(0, 9))),
                max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_tolerance_match_against_brute_force(spark, targets, laps):
    from racelake.operators.match import tolerance_match
    t = spark.createDataFrame(targets, "k int, target int")
    lp = spark.createDataFrame(laps, "lk int, lap int, ms int, sector int")
    got = {r.k: (r.lap, r.sector) for r in
           tolerance_match(t, lp, [("k", "lk")], "target", "ms", 50, ["k"], ["lap", "sector"], "lap").collect()}
    want = {}
    for k, target in targets:
        cands = sorted((abs(ms - target), lap, sector) for lk, lap, ms, sector in laps if lk == k and abs(ms - target) <= 50)
        if cands:
            want[k] = (cands[0][1], cands[0][2])
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20000), st.one_of(st.none(), st.integers(0, 3)),
                          st.integers(0, 2)), min_size=1, max_size=50, unique_by=lambda r: (r[0], r[1])),
       st.sampled_from(["10 minutes", 3600, "2 hours"]))
def test_bucketed_change_flag_equals_plain(spark, samples, bucket):
    from racelake.operators.windows import change_flag
    ts = lambda s: T0 + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(k, ts(s), x, y) for k, s, x, y in samples], "k int, t timestamp, x int, y int")
    plain = sorted(tuple(r) for r in change_flag(df, ["k"], "t", ["x", "y"], "f").collect())
    bucketed = sorted(tuple(r) for r in change_flag(df, ["k"], "t", ["x", "y"], "f", bucket=bucket).collect())
    assert bucketed == plain


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=40))
def test_latest_by_key_against_brute_force(spark, rows_):
    from racelake.operators.dedup import latest_by_key
    df = spark.createDataFrame(rows_, "k int, version int, v int")
    got = sorted(tuple(r) for r in latest_by_key(df, ["k"], "version", ["v"]).collect())
    want = sorted(max((r for r in rows_ if r[0] == k), key=lambda r: (r[1], r[2])) for k in {r[0] for r in rows_})
    assert got == want
