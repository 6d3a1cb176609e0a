"""Model rules on hand-made rows: N2, N3, N4, N6, N10, N13, N16, N17, N21."""

import datetime as dt

from racelake.operators.asof import HotKeys
from racelake.plans import models as M
from racelake.plans import quality as Q
from tests.conftest import rows

T0 = dt.datetime(2024, 3, 2, 14, 0, 0)


def ts(s):
    return T0 + dt.timedelta(seconds=s)


def _telemetry_inputs(spark):
    car = spark.createDataFrame(
        [(9, 1, ts(s), 100 + s, 0, 0, 0, 0, 0) for s in (0, 5, 10, 15, 20, 25, 30, 35)],
        "session_key int, driver_number int, date timestamp, speed int, rpm int, n_gear int, throttle int, brake int, drs int")
    laps = spark.createDataFrame([(9, 1, 1, ts(4), 0), (9, 1, 2, ts(20), 1)],
                                 "session_key int, driver_number int, lap_number int, lap_start timestamp, is_pit_out_lap int")
    loc = spark.createDataFrame([(9, 1, ts(6), 0, 0, 0), (9, 1, ts(14), 3, 0, 0), (9, 1, ts(24), 3, 0, 0)],
                                "session_key int, driver_number int, date timestamp, x int, y int, z int")
    dist = spark.createDataFrame([(9, 1, ts(0), 1.0), (9, 1, ts(30), 2.0)],
                                 "session_key int, driver_number int, date timestamp, distance_m double")
    return car, laps, loc, dist


def test_lap_telemetry_rules(spark):
    car, laps, loc, dist = _telemetry_inputs(spark)
    b = M.lap_boundaries(laps)
    # The last lap stays open
    assert {r.lap_number: r.lap_end for r in b.collect()}[2] is None
    out = {r.date: r for r in M.lap_telemetry_core(car, b, loc, dist).collect()}
    assert ts(0) not in out                       # before the first lap start: sliced away
    assert out[ts(5)].lap_number == 1 and out[ts(20)].lap_number == 2 and out[ts(35)].lap_number == 2
    assert out[ts(5)].x is None                   # no GPS yet: NULL, not 0 (N1)
    # First kept sample compares with 0; NULL counts as 0
    assert out[ts(5)].gps_updated == 0 and out[ts(10)].gps_updated == 0
    assert out[ts(15)].gps_updated == 1 and out[ts(25)].gps_updated == 0
    assert out[ts(30)].distance_m == 2.0 and out[ts(25)].distance_m == 1.0
    for bucket in ("10 seconds", 7, HotKeys(2), HotKeys(5), HotKeys(10**6)):
        got = {r.date: tuple(r) for r in M.lap_telemetry_core(car, b, loc, dist, bucket=bucket).collect()}
        assert got == {k: tuple(v) for k, v in out.items()}
    assert Q.boundary_consistency(b, ["session_key", "driver_number"]).count() == 0


def _calendar(spark):
    races = spark.createDataFrame([(2024, 1, dt.date(2024, 3, 2)), (2024, 2, dt.date(2024, 3, 9)),
                                   (2024, 3, dt.date(2024, 11, 23))], "season int, round int, race_date date")
    sessions = spark.createDataFrame([
        (11, 100, 2024, "Qualifying", "Qualifying", dt.datetime(2024, 3, 1, 16)),
        (12, 100, 2024, "Race", "Race", dt.datetime(2024, 3, 2, 15)),
        (21, 200, 2024, "Sprint Qualifying", "Qualifying", dt.datetime(2024, 3, 7, 16)),
        (22, 200, 2024, "Sprint", "Race", dt.datetime(2024, 3, 8, 16)),
        (23, 200, 2024, "Qualifying", "Qualifying", dt.datetime(2024, 3, 8, 20)),
        (24, 200, 2024, "Race", "Race", dt.datetime(2024, 3, 9, 15)),
        # night race: UTC date is the day after the calendar date
        (32, 300, 2024, "Race", "Race", dt.datetime(2024, 11, 24, 6)),
    ], "session_key int, meeting_key int, year int, session_name string, session_type string, date_start timestamp")
    return races, sessions


def test_session_map_sprint_and_night_race(spark):
    races, sessions = _calendar(spark)
    sm = {r.session_key: r for r in M.session_map(sessions, races).collect()}
    assert sm[12].round == 1 and sm[24].round == 2 and sm[32].round == 3
    assert sm[22].canonical_type == "Sprint" and sm[24].canonical_type == "Race"        # N10
    assert sm[21].canonical_type == "Sprint Qualifying" and sm[23].canonical_type == "Qualifying"
    assert all(sm[k].round == 2 for k in (21, 22, 23, 24))


def test_fact_qualifying_one_lap_supplies_all(spark):
    races, sessions = _calendar(spark)
    smap = M.session_map(sessions, races)
    quali = spark.createDataFrame([(2024, 1, "max", "rb", 1, "1:30.000", None, None),
                                   (2024, 1, "bob", "x", 2, "1:31.000", None, None),
                                   (2024, 1, "zed", "x", 3, None, None, None)],
                                  "season int, round int, driver_id string, constructor_id string, qualifying_position int, "
                                  "q1 string, q2 string, q3 string")
    dmap = spark.createDataFrame([("max", 1, 2024), ("bob", 2, 2024)],
                                 "jolpica_driver_id string, openf1_driver_number int, season int")
    laps = spark.createDataFrame([
        (11, 1, 3, 90.04, 0, 30.0, None, 30.0, 300, 301, 302),   # within 50 ms (40 ms), sector 2 NULL
        (11, 1, 4, 90.01, 0, 29.0, 31.0, 30.01, 310, 311, 312),  # closest (10 ms)
        (11, 1, 5, 90.0, 1, 1.0, 1.0, 1.0, 1, 1, 1),             # pit-out: ignored
        (11, 2, 1, 91.2, 0, 1.0, 1.0, 1.0, 1, 1, 1),             # 200 ms off: mismatch
    ], "session_key int, driver_number int, lap_number int, lap_duration double, is_pit_out_lap int, "
       "duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, i1_speed int, i2_speed int, st_speed int")
    fq = {r.driver_id: r for r in M.fact_qualifying(quali, dmap, smap, laps).collect()}
    m = fq["max"]
    assert (m.best_lap_number, m.best_s2, m.i1_speed, m.best_source_match) == (4, 31.0, 310, "matched")
    assert m.jolpica_best_time_ms == 90000 and m.openf1_best_time_ms == 90010
    assert fq["bob"].best_source_match == "mismatch" and fq["bob"].best_lap_number is None
    assert fq["zed"].best_source_match is None
    # An incremental run skips loaded rounds
    again = M.fact_qualifying(quali, dmap, smap, laps, existing=M.fact_qualifying(quali, dmap, smap, laps))
    assert again.count() == 0


def test_dim_drivers_headshot_rule(spark):
    drivers = spark.createDataFrame([("max", "Max", "V", "Max V", None, "NED", 33, "VER", "u"),
                                     ("old", "Old", "T", "Old T", None, "X", None, None, "u")],
                                    "driver_id string, given_name string, family_name string, full_name string, "
                                    "date_of_birth date, nationality string, permanent_number int, driver_code string, url string")
    dmap = spark.createDataFrame([("max", 1, 2024), ("max", 33, 2022), ("old", 1, 2010)],
                                 "jolpica_driver_id string, openf1_driver_number int, season int")
    od = spark.createDataFrame([(9001, 1, "a.png"), (9500, 1, ""), (9400, 1, "b.png"), (9600, 33, "c.png")],
                               "session_key int, driver_number int, headshot_url string")
    got = {r.driver_id: r.headshot_url for r in M.dim_drivers(drivers, dmap, od).collect()}
    # number-only join from 2023 on; empty url skipped (N17); highest session wins
    assert got == {"max": "b.png", "old": None}


def test_strategy_keeps_every_stint_and_stop(spark):
    fr = spark.createDataFrame([(2024, 1, "max", "rb", 9, 1), (2024, 1, "old", "x", None, None), (2024, 1, "one", "rb", 9, 2),
                                (2024, 1, "non", "rb", 9, 3), (2024, 1, "pre", "x", None, None)],
                               "season int, round int, jolpica_driver_id string, constructor_id string, "
                               "session_key int, openf1_driver_number int")
    pits = spark.createDataFrame([(2024, 1, "max", 1, 12, 2300), (2024, 1, "max", 2, 30, 2400), (2024, 1, "one", 1, 20, 2500),
                                  (2024, 1, "pre", 1, 7, 2600)],
                                 "season int, round int, driver_id string, stop_number int, lap_number int, pit_duration_ms long")
    stints = spark.createDataFrame([(9, 1, 1, 1, 12, "SOFT", 0), (9, 1, 2, 13, 30, "HARD", 0), (9, 1, 3, 31, None, "SOFT", 3),
                                    (9, 2, 1, 1, 20, "SOFT", 0), (9, 2, 2, 21, None, "HARD", 0), (9, 3, 1, 1, None, "HARD", 0)],
                                   "session_key int, driver_number int, stint_number int, lap_start int, lap_end int, "
                                   "compound string, tyre_age_at_start int")
    got = rows(M.strategy(fr, pits, stints).select("driver_id", "stop_number", "stint_number", "compound"))
    assert got == sorted([("max", 1, 1, "SOFT"), ("max", 2, 2, "HARD"), ("max", None, 3, "SOFT"), ("old", None, None, None),
                          ("one", 1, 1, "SOFT"), ("one", None, 2, "HARD"), ("non", None, 1, "HARD"), ("pre", 1, None, None)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_dim_circuits_constants_and_json_fallback(spark):
    """J14 + F5: the fixed constants update listed circuits; unlisted ones keep
    their values, falling back to the raw JSON when the columns are empty."""
    from racelake.operators.lookups import circuit_stats
    raw = spark.createDataFrame([
        ("bahrain", "u", "Bahrain", "Sakhir", "BH", 26.0, 50.5, None, None, None, '{"length": "1"}'),
        ("old_ring", "u", "Old", "X", "Y", 1.0, 2.0, 100.0, None, None, '{"length": "4.1", "turns": "12"}'),
        ("plain", "u", "P", "X", "Y", 1.0, 2.0, None, 3.0, 9, "{}"),
    ], "circuit_id string, url string, circuit_name string, locality string, country string, lat double, lng double, "
       "alt double, length_km double, corners int, _raw_json string")
    got = {r.circuit_id: (r.length_km, r.corners) for r in M.dim_circuits(raw, circuit_stats(spark)).collect()}
    assert got == {"bahrain": (5.412, 15), "old_ring": (4.1, 12), "plain": (3.0, 9)}


def test_lap_bounds_follow_lap_order(spark):
    """Lap 3 starts before lap 2: the windows still follow the lap numbers."""
    laps = spark.createDataFrame([(9, 1, 1, ts(0)), (9, 1, 2, ts(300)), (9, 1, 3, ts(180)), (9, 1, 4, ts(480))],
                                 "session_key int, driver_number int, lap_number int, lap_start timestamp")
    assert {r.lap_number: r.lap_end for r in M.lap_boundaries(laps).collect()} == {1: ts(300), 2: ts(180), 3: ts(480), 4: None}


def test_change_flag_at_equal_times(spark):
    """Both forms order equal times by value."""
    from racelake.operators.windows import change_flag
    data = [(1, ts(0), 1, 0), (1, ts(5), 3, 0), (1, ts(5), 2, 0), (1, ts(5), 2, 0), (1, ts(3600), 3, 0), (1, ts(7200), 3, 0)]
    df = spark.createDataFrame(data, "k int, t timestamp, x int, y int")
    plain = rows(change_flag(df, ["k"], "t", ["x", "y"], "f"))
    assert plain == rows(change_flag(df, ["k"], "t", ["x", "y"], "f", bucket="1 hour"))
    assert [(r[1], r[2], r[-1]) for r in sorted(plain)] == [
        (ts(0), 1, 1), (ts(5), 2, 0), (ts(5), 2, 1), (ts(5), 3, 1), (ts(3600), 3, 0), (ts(7200), 3, 0)]


def test_telemetry_core_plan_shape(spark):
    """The M17 core plans as 2 hash exchanges and 2 sorts (lap bounds; the
    union of all inputs); the lap slice and the change flag reuse them."""
    car, laps, loc, dist = _telemetry_inputs(spark)
    core = M.lap_telemetry_core(car, M.lap_boundaries(laps), loc, dist)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = core._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert plan.count("Exchange hashpartitioning") == 2
    # lap bounds, the union, and the flag's order of equal times (inside a partition)
    assert plan.count("Sort [") == 3
