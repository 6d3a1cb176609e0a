"""Landing-page parsers on hand-made pages carrying every edge row of the feeds."""

import json
import math

from racelake.sources import jolpica as J
from racelake.sources import openf1 as O
from racelake.sources.bridge import driver_number_bridge
from racelake.sources.distance import clean_distance


def _page(spark, obj):
    return spark.createDataFrame([(json.dumps(obj),)], "json string")


def _races(races):
    return {"MRData": {"total": "1", "RaceTable": {"season": "2024", "Races": races}}}


def test_results_edge_rows(spark):
    res = [
        {"number": "1", "position": "1", "positionText": "1", "points": "25", "grid": "2", "laps": "57",
         "status": "Finished", "Driver": {"driverId": "max"}, "Constructor": {"constructorId": "rb"},
         "Time": {"millis": "5504742"},
         "FastestLap": {"rank": "1", "lap": "39", "Time": {"time": "1:32.608"}, "AverageSpeed": {"speed": "210.383"}}},
        {"number": "2", "position": "R", "positionText": "R", "positionOrder": "19", "points": "0", "grid": "5",
         "laps": "3", "status": "Accident", "Driver": {"driverId": "bob"}, "Constructor": {"constructorId": "x"},
         "FastestLap": {"rank": "20", "Time": {"time": "1:40.000"}}},
        {"number": "3", "position": "", "positionText": "W", "grid": "0", "Driver": {"driverId": "cid"},
         "Constructor": {"constructorId": "x"}},
    ]
    df = J.parse_results(_page(spark, _races([{"season": "2024", "round": "1", "Results": res}])))
    got = {r.driver_id: r for r in df.collect()}
    assert got["max"].position == 1 and got["max"].time_millis == 5504742 and got["max"].fastest_lap_speed == 210.383
    assert got["bob"].position is None and got["bob"].position_order == 19 and got["bob"].time_millis is None
    assert got["bob"].fastest_lap_rank == 20 and got["bob"].fastest_lap_speed is None
    assert got["cid"].position is None and got["cid"].position_order == 0 and got["cid"].points == 0.0
    assert got["cid"].laps == 0 and got["cid"].status == "" and got["cid"].fastest_lap_time is None
    assert all(r._raw_json.startswith("{") and r._ingested_at is not None for r in got.values())


def test_laps_and_pit_durations(spark):
    laps = [{"number": "1", "Timings": [{"driverId": "a", "position": "1", "time": "1:35.123"},
                                        {"driverId": "b", "position": "2", "time": "1:3x.1"}]}]
    stops = [{"driverId": "a", "lap": "10", "stop": "1", "time": "14:10:00", "duration": d} for d in
             ("17:03.456", "22.5", "1:02:03.456", "")]
    page = _page(spark, _races([{"season": "2024", "round": "3", "Laps": laps, "PitStops": stops}]))
    lt = {r.driver_id: r.time_millis for r in J.parse_lap_times(page).collect()}
    assert lt == {"a": 95123, "b": None}
    assert [r.duration_millis for r in J.parse_pit_stops(page).collect()] == [1023456, 22500, None, None]


def test_standings_first_constructor(spark):
    page = {"MRData": {"total": "2", "StandingsTable": {"season": "2024", "StandingsLists": [{
        "season": "2024", "round": "5", "DriverStandings": [
            {"position": "1", "positionText": "1", "points": "110", "wins": "4", "Driver": {"driverId": "max"},
             "Constructors": [{"constructorId": "rb"}, {"constructorId": "other"}]},
            {"position": "2", "positionText": "2", "points": "80", "wins": "0", "Driver": {"driverId": "new"},
             "Constructors": []}]}]}}}
    got = {r.driver_id: r.constructor_id for r in J.parse_driver_standings(_page(spark, page)).collect()}
    assert got == {"max": "rb", "new": ""}


def test_circuits_and_drivers_optional_fields(spark):
    circuits = {"MRData": {"total": "2", "CircuitTable": {"Circuits": [
        {"circuitId": "bahrain", "url": "u", "circuitName": "B", "Location": {"lat": "26.0", "long": "50.5",
         "locality": "S", "country": "BH", "alt": ""}, "length": "5.412", "turns": "15"},
        {"circuitId": "old", "url": "u", "circuitName": "O", "Location": {"lat": "1", "long": "2", "locality": "L",
                                                                           "country": "C"}}]}}}
    got = {r.circuit_id: r for r in J.parse_circuits(_page(spark, circuits)).collect()}
    assert got["bahrain"].alt is None and got["bahrain"].length_km == 5.412 and got["bahrain"].corners == 15
    assert got["old"].length_km is None and got["old"].corners is None
    drivers = {"MRData": {"total": "1", "DriverTable": {"Drivers": [{"driverId": "x", "permanentNumber": ""}]}}}
    d = J.parse_drivers(_page(spark, drivers)).first()
    assert (d.url, d.given_name, d.nationality, d.permanent_number, d.code) == ("", "", "", None, None)


def test_timing_feed_edge_rows(spark):
    laps = [
        {"session_key": 9, "driver_number": 1, "lap_number": 1, "date_start": "2024-03-02T15:03:00.5+00:00",
         "is_pit_out_lap": True, "segments_sector_1": [2048, None, 2051], "segments_sector_2": None},
        {"session_key": 9, "driver_number": 1, "lap_number": 2, "date_start": None},
        {"session_key": 9, "driver_number": 1, "lap_number": 3, "date_start": ""},
    ]
    got = O.parse_laps(spark.createDataFrame([(json.dumps(laps),)], "json string")).collect()
    assert len(got) == 1
    r = got[0]
    assert r.segments_sector_1 == [2048, 2051] and r.segments_sector_2 == [] and r.is_pit_out_lap == 1
    iv = [{"session_key": 9, "driver_number": 1, "date": "d", "gap_to_leader": "+1 LAP", "interval": 0.25},
          {"session_key": 9, "driver_number": 2, "date": "d", "gap_to_leader": 1.5}]
    ivs = O.parse_intervals(spark.createDataFrame([(json.dumps(iv),)], "json string")).collect()
    assert [(r.gap_to_leader, r.interval) for r in ivs] == [(None, 0.25), (1.5, None)]
    st = [{"session_key": 9, "driver_number": 1, "stint_number": 1, "lap_start": None},
          {"session_key": 9, "driver_number": 1, "stint_number": 2, "lap_start": 20}]
    sts = O.parse_stints(spark.createDataFrame([(json.dumps(st),)], "json string")).collect()
    assert [(r.stint_number, r.compound, r.tyre_age_at_start) for r in sts] == [(2, "", 0)]
    dr = [{"session_key": 9, "driver_number": 1, "team_colour": "", "headshot_url": ""},
          {"session_key": 9, "driver_number": 2, "team_colour": "3671C6"}]
    drs = O.parse_drivers(spark.createDataFrame([(json.dumps(dr),)], "json string")).collect()
    assert [(r.team_colour, r.headshot_url, r.full_name) for r in drs] == [("", "", ""), ("3671C6", None, "")]


def test_distance_clean_reference_cases(spark):
    """The distance feed's own unit cases: columns, negative filter, NaN filter, keys, empty."""
    import datetime as dt
    t0 = dt.datetime(2024, 3, 2, 14, 0)
    frame = lambda ds: spark.createDataFrame(
        [(t0 + dt.timedelta(milliseconds=270 * i), d) for i, d in enumerate(ds)], "Date timestamp, Distance double")
    out = clean_distance(frame([0.0, 10.5, 21.0]), session_key=9001, driver_number=1)
    assert out.columns[:4] == ["session_key", "driver_number", "date", "distance_m"]
    assert [r.distance_m for r in out.collect()] == [0.0, 10.5, 21.0]
    assert [r.distance_m for r in clean_distance(frame([-1.0, 0.0, 10.5, 21.0]), session_key=9001, driver_number=1)
            .collect()] == [0.0, 10.5, 21.0]
    assert [r.distance_m for r in clean_distance(frame([0.0, math.nan, 21.0]), session_key=9001, driver_number=1)
            .collect()] == [0.0, 21.0]
    keyed = clean_distance(frame([1.0]), session_key=9001, driver_number=44).first()
    assert (keyed.session_key, keyed.driver_number) == (9001, 44)
    empty = spark.createDataFrame([], "Date timestamp, Distance double")
    e = clean_distance(empty, session_key=9001, driver_number=1)
    assert e.count() == 0 and "distance_m" in e.columns


def test_bridge_priority(spark):
    nums = spark.createDataFrame([(2024, 1, "max", 1), (2024, 2, "max", 1), (2024, 1, "sub", 40), (2024, 2, "lando", 4)],
                                 "season int, round int, driver_id string, number int")
    drivers = spark.createDataFrame([(2024, "max", 33), (2024, "lando", 4), (2024, "reserve", 50), (2024, "sub", 1)],
                                    "season int, driver_id string, permanent_number int")
    got = {r.jolpica_driver_id: r.openf1_driver_number for r in driver_number_bridge(nums, drivers).collect()}
    # raced numbers win, the free permanent number 33 fills for max only if max has no raced row (he has)
    assert got == {"max": 1, "lando": 4, "sub": 40, "reserve": 50}
