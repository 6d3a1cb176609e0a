"""Batch pipeline end to end on the fixture inputs (sf0.001), incremental rules,
layout, schema evolution and the availableNow stream."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from racelake.contract.inputs import Inputs
from racelake.plans import pipeline as P
from racelake.plans import models as M
from racelake.sources import openf1 as O
from racelake.streaming.ingest import run_available_now

SF = "/root/testdata/sf0.001"


def _stg(spark, car=None, ingested="2024-02-01 00:00:00"):
    i = Inputs(spark, SF)
    stamp = lambda df: df.withColumn("_ingested_at", F.lit(ingested).cast("timestamp"))
    return {
        "sessions": i.sessions(), "races": i.races(), "laps": i.of1_laps(), "telemetry_laps": i.lap_starts(),
        "sprint_results": i.sprint(), "circuits_raw": i.circuits_raw(), "drivers": i.drivers(),
        "driver_map": i.driver_map(), "of1_drivers": i.of1_drivers(), "constructors": i.constructors(),
        "results": i.results(), "jolpica_laps": i.jlaps(), "qualifying": i.quali(),
        "driver_standings": i.driver_standings(), "constructor_standings": i.constructor_standings(),
        "pit_stops": i.pit_stops(), "stints": i.stints(),
        "car_data": stamp(car if car is not None else i.car().drop("event_id")),
        "location": stamp(i.location()), "distances": stamp(i.distance()),
    }


@pytest.fixture(scope="module")
def warehouse(spark):
    root = tempfile.mkdtemp(prefix="racelake-wh-")
    wh = P.Warehouse(root)
    from racelake.operators.lookups import circuit_stats
    P.run_marts(spark, wh, _stg(spark), circuit_stats(spark), 1998)
    return wh


def test_all_marts_written(spark, warehouse):
    for layer, name in [("intermediate", "session_map"), ("marts", "dim_drivers"), ("marts", "fact_laps"),
                        ("marts", "fact_qualifying"), ("marts", "standings"), ("marts", "strategy"),
                        ("marts", "qualifying_summary"), ("marts", "lap_telemetry")]:
        assert spark.read.parquet(warehouse.path(layer, name)).count() > 0, name


def test_rerun_appends_nothing(spark, warehouse):
    before = spark.read.parquet(warehouse.path("marts", "fact_race_results")).count()
    i = Inputs(spark, SF)
    smap = spark.read.parquet(warehouse.path("intermediate", "session_map"))
    P.append_unseen(spark, M.driver_race_results(i.results(), i.driver_map(), smap, i.of1_laps()),
                    warehouse.path("marts", "fact_race_results"))
    assert spark.read.parquet(warehouse.path("marts", "fact_race_results")).count() == before


def test_telemetry_layout_prunes(spark, warehouse):
    path = warehouse.path("marts", "lap_telemetry")
    assert any(d.startswith("year=") for d in os.listdir(path))
    q = spark.read.parquet(path).filter(F.col("session_key") == 9000)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_key" in plan


def test_incremental_telemetry_equals_full_refresh(spark):
    """Metamorphic: two ingest batches + per-session rebuild == one full build."""
    i = Inputs(spark, SF)
    car = i.car().drop("event_id")
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    smap = M.session_map(i.sample_sessions(), i.sample_races())
    b = M.lap_boundaries(i.lap_starts())

    def stamp(df, t):
        return df.withColumn("_ingested_at", F.lit(t).cast("timestamp"))

    inc = P.Warehouse(tempfile.mkdtemp(prefix="racelake-inc-"))
    first = stamp(car.filter(F.col("date") < cut), "2024-02-01 00:00:00")
    P.rebuild_telemetry(spark, inc, first, b, stamp(i.location(), "2024-02-01 00:00:00"),
                        stamp(i.distance(), "2024-02-01 00:00:00"), smap, i.sample_drivers(), i.sample_driver_map())
    both = first.unionByName(stamp(car.filter(F.col("date") >= cut), "2024-02-02 00:00:00"))
    P.rebuild_telemetry(spark, inc, both, b, stamp(i.location(), "2024-02-01 00:00:00"),
                        stamp(i.distance(), "2024-02-01 00:00:00"), smap, i.sample_drivers(), i.sample_driver_map())
    full = M.lap_telemetry(both, b, i.location(), i.distance(), smap, i.sample_drivers(), i.sample_driver_map())
    cols = [c for c in full.columns if c != "_ingested_at"]
    got = spark.read.parquet(inc.path("marts", "lap_telemetry")).select(*cols)
    want = full.select(*cols)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*[F.col(c).cast(got.schema[c].dataType) for c in cols])).count() == 0


def test_schema_evolution(spark):
    path = tempfile.mkdtemp(prefix="racelake-evo-") + "/t"
    spark.createDataFrame([(1,)], "k int").write.parquet(path)
    spark.createDataFrame([(2, 5)], "k int, gps_updated int").write.mode("append").parquet(path)
    df = P.ensure_columns(P.read_evolving(spark, path), {"gps_updated": ("int", 0), "distance_m": ("double", None)})
    assert sorted((r.k, r.gps_updated, r.distance_m) for r in df.collect()) == [(1, 0, None), (2, 5, None)]


def test_stream_resumes_without_duplicates(spark):
    root = tempfile.mkdtemp(prefix="racelake-stream-")
    land, raw, ck = f"{root}/landing", f"{root}/raw", f"{root}/ck"
    os.makedirs(land)
    page = lambda n: json.dumps([{"session_key": 9, "driver_number": 1, "date": f"2024-03-02T14:00:0{n}.000Z",
                                  "speed": n}])
    with open(f"{land}/a.json", "w") as f:
        f.write(page(1) + "\n")
    run_available_now(spark, land, O.parse_car_data, raw, ck)
    assert spark.read.parquet(raw).count() == 1
    with open(f"{land}/b.json", "w") as f:
        f.write(page(2) + "\n")
    run_available_now(spark, land, O.parse_car_data, raw, ck)   # only the new file is read
    run_available_now(spark, land, O.parse_car_data, raw, ck)   # nothing new
    assert sorted(r.speed for r in spark.read.parquet(raw).collect()) == [1, 2]


def test_eligible_sessions(spark):
    s = spark.createDataFrame([(1, "Race", "2024-03-02T17:00:00+00:00"), (2, "Practice 1", "2024-03-01T12:00:00+00:00"),
                               (3, "Qualifying", "2030-01-01T00:00:00+00:00")],
                              "session_key int, session_type string, date_end string")
    assert [r.session_key for r in P.eligible_sessions(s, "2025-01-01 00:00:00").collect()] == [1]


def test_load_weekend_status(spark):
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-wk-"))
    good = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "season int, round int, v string")
    bad = spark.createDataFrame([(2024, 1, "x")], "season int, round int, v string").withColumn(
        "v", F.raise_error(F.lit("boom")))
    st = {r.table: r.status for r in P.load_weekend_status(spark, wh, {"results": good, "laps": bad}, 2024, 1).collect()}
    assert st == {"results": "ok", "laps": "failed"}
    assert spark.read.parquet(wh.path("raw", "results")).count() == 1


def test_reingest_overwrites_only_chosen_sessions(spark):
    """I4: re-ingesting chosen sessions replaces just their partitions."""
    from racelake.operators.incremental import overwrite_partitions, write_append
    path = tempfile.mkdtemp(prefix="racelake-i4-") + "/t"
    write_append(spark.createDataFrame([(1, "a"), (2, "b")], "session_key int, v string"), path, ["session_key"])
    overwrite_partitions(spark.createDataFrame([(2, "b2")], "session_key int, v string"), path, ["session_key"])
    assert sorted((r.session_key, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b2")]
    # An empty batch appends nothing
    write_append(spark.createDataFrame([], "session_key int, v string"), path, ["session_key"])
    assert spark.read.parquet(path).count() == 2


def test_stream_telemetry_matches_batch(spark):
    """Telemetry kept current by the stream (one file per micro-batch) equals
    the batch model over all samples."""
    from racelake.streaming.ingest import stream_telemetry
    from tests.test_models import _telemetry_inputs
    car, laps, loc, dist = _telemetry_inputs(spark)
    stamp = lambda df: df.withColumn("_ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    root = tempfile.mkdtemp(prefix="racelake-st-")
    land = f"{root}/landing"
    os.makedirs(land)
    wh = P.Warehouse(f"{root}/wh")
    b = M.lap_boundaries(laps)
    smap = spark.createDataFrame([(9, 2024, 1, "Race")], "session_key int, season int, round int, session_type string")
    od = spark.createDataFrame([(9, 1, "VER", "RB", "3671C6")],
                               "session_key int, driver_number int, name_acronym string, team_name string, team_colour string")
    dm = spark.createDataFrame([("max", 1, 2024)], "jolpica_driver_id string, openf1_driver_number int, season int")
    pages = [[{"session_key": r.session_key, "driver_number": r.driver_number,
               "date": r.date.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z", "speed": r.speed} for r in chunk]
             for chunk in (car.collect()[:4], car.collect()[4:])]
    for n, page in enumerate(pages):
        with open(f"{land}/p{n}.json", "w") as f:
            f.write(json.dumps(page) + "\n")
        stream_telemetry(spark, land, wh, f"{root}/ck", b, stamp(loc), stamp(dist), smap, od, dm)
    got = spark.read.parquet(wh.path("marts", "lap_telemetry"))
    want = M.lap_telemetry(car, b, loc, dist, smap, od, dm)
    key = lambda r: r.date
    assert [(r.date, r.lap_number, r.gps_updated, r.driver_id) for r in sorted(got.collect(), key=key)] == \
           [(r.date, r.lap_number, r.gps_updated, r.driver_id) for r in sorted(want.collect(), key=key)]


def test_landing_to_staging(spark):
    """Landing pages (one JSON page per line) -> raw tables -> staging views."""
    root = tempfile.mkdtemp(prefix="racelake-land-")
    res = {"MRData": {"total": "2", "RaceTable": {"season": "2024", "Races": [{
        "season": "2024", "round": "1", "raceName": "GP", "Circuit": {"circuitId": "bahrain"}, "date": "2024-03-02",
        "url": "u", "Results": [
            {"number": "1", "position": "1", "positionText": "1", "points": "25", "grid": "1", "laps": "57",
             "status": "Finished", "Driver": {"driverId": "max"}, "Constructor": {"constructorId": "rb"}},
            {"number": "2", "position": "R", "positionText": "R", "positionOrder": "20", "points": "0", "grid": "2",
             "laps": "3", "status": "Accident", "Driver": {"driverId": "bob"}, "Constructor": {"constructorId": "x"}}]}]}}}
    sess = [{"session_key": 9, "session_name": "Race", "session_type": "Race", "date_start": "2024-03-02T15:00:00+00:00",
             "date_end": "2024-03-02T17:00:00+00:00", "year": 2024, "meeting_key": 1}]
    car = [{"session_key": 9, "driver_number": 1, "date": "2024-03-02T15:00:00.270Z", "speed": 200}]
    for folder, obj in [("results/results", res), ("results/races", res), ("timing/sessions", sess),
                        ("timing/car_data", car)]:
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/page-0.json", "w") as f:
            f.write(json.dumps(obj) + "\n")
    wh = P.Warehouse(f"{root}/wh")
    assert sorted(P.ingest_landing(spark, root, wh, "2024-03-04 06:00:00")) == ["car_data", "races", "results", "sessions"]
    stg = P.stage_all(spark, wh)
    r = {x.driver_id: x for x in stg["results"].collect()}
    assert r["max"].finish_position == 1 and r["bob"].finish_position is None and r["bob"].position_order == 20
    assert stg["races"].first().race_date == dt.date(2024, 3, 2)
    s = stg["sessions"].first()
    assert s.date_start == dt.datetime(2024, 3, 2, 15, 0) and s._source == "openf1"
    assert stg["car_data"].first().speed == 200
    assert any(d.startswith("year=2024") for d in os.listdir(wh.path("raw", "car_data")))


def _page(root, folder, name, obj):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with open(f"{root}/{folder}/{name}", "w") as f:
        f.write((obj if isinstance(obj, str) else json.dumps(obj)) + "\n")


def test_split_sessions_new_files_and_rejects(spark):
    """Pages of one session in two files and runs, a page twice, a broken line, and a
    file:// root: nothing is lost, doubled or silently dropped."""
    root = tempfile.mkdtemp(prefix="racelake-split-")
    car = lambda d, n: [{"session_key": 9, "driver_number": d, "date": f"2024-03-02T15:00:0{n}.000Z", "speed": 200 + d}]
    weather = [{"session_key": 9, "date": "2024-03-02T15:00:00+00:00", "air_temperature": 20.5}]
    _page(root, "timing/car_data", "a.json", car(1, 1))
    _page(root, "timing/weather", "a.json", weather)
    wh = P.Warehouse(f"{root}/wh")
    assert sorted(P.ingest_landing(spark, "file://" + root, wh, "2024-03-04 06:00:00")) == ["car_data", "weather"]
    assert P.ingest_landing(spark, "file://" + root, wh, "2024-03-05 06:00:00") == []
    _page(root, "timing/car_data", "b.json", car(2, 2))
    _page(root, "timing/car_data", "c.json", "not json {")
    _page(root, "timing/weather", "b.json", weather)          # fetched again
    assert sorted(P.ingest_landing(spark, "file://" + root, wh, "2024-03-06 06:00:00")) == ["car_data", "weather"]
    stg = P.stage_all(spark, wh)
    assert sorted(r.driver_number for r in stg["car_data"].collect()) == [1, 2]
    assert stg["weather"].count() == 1
    bad = P.rejects(spark, wh).collect()
    assert [(r.table, r.file.split("/")[-1], r.n) for r in bad] == [("car_data", "c.json", 1)]


def test_other_errors_are_not_an_absent_table(spark, tmp_path):
    assert P.read_if_written(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception):  # noqa: B017
        P.read_if_written(spark, str(tmp_path / "broken"))


def test_watermarks_converge(spark):
    """Late GPS marks its session once; a run without news rebuilds nothing."""
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-wm-"))
    at = lambda s: dt.datetime(2024, 3, 2, 15, 0, s)
    day = lambda d: dt.datetime(2024, 4, d)
    car = spark.createDataFrame([(k, 1, at(5), 100, 1, 1, 1, 0, 0, day(1)) for k in (8, 9)],
                                "session_key int, driver_number int, date timestamp, speed int, rpm int, n_gear int, throttle int, "
                                "brake int, drs int, _ingested_at timestamp")
    laps = spark.createDataFrame([(k, 1, 1, at(0), 0) for k in (8, 9)],
                                 "session_key int, driver_number int, lap_number int, lap_start timestamp, is_pit_out_lap int")
    gps = lambda rows_: spark.createDataFrame(rows_, "session_key int, driver_number int, date timestamp, x int, y int, z int, _ingested_at timestamp")
    dist = spark.createDataFrame([(9, 1, at(1), 7.5, day(1))], "session_key int, driver_number int, date timestamp, distance_m double, _ingested_at timestamp")
    smap = spark.createDataFrame([(8, 2024, 1, "Race"), (9, 2024, 2, "Race")], "session_key int, season int, round int, session_type string")
    drivers = spark.createDataFrame([(9, 1, "AAA", "T", "ffffff")], "session_key int, driver_number int, name_acronym string, team_name string, team_colour string")
    numbers = spark.createDataFrame([("max", 1, 2024)], "jolpica_driver_id string, openf1_driver_number int, season int")
    run = lambda loc: P.rebuild_telemetry(spark, wh, car, M.lap_boundaries(laps), loc, dist, smap, drivers, numbers)
    first = [(9, 1, at(1), 1, 1, 1, day(1))]
    assert run(gps(first)) == 2
    assert run(gps(first)) == 0
    late = [*first, (8, 1, at(2), 4, 4, 4, day(3))]
    assert run(gps(late)) == 1
    assert run(gps(late)) == 0
    got = {r.session_key: (r.x, r.distance_m) for r in spark.read.parquet(wh.path("marts", "lap_telemetry")).collect()}
    assert got == {8: (4, None), 9: (1, 7.5)}


def test_staging_timing_views(spark):
    from racelake.plans import staging as STG
    raw = O.parse_intervals(spark.createDataFrame(
        [(json.dumps([{"session_key": 9, "driver_number": 1, "date": "2024-03-02T15:00:01.750+00:00",
                       "gap_to_leader": "+1 LAP", "interval": 0.5}]),)], "json string"), "2024-03-04 00:00:00")
    r = STG.stg_intervals(raw).first()
    assert r.interval_date == dt.datetime(2024, 3, 2, 15, 0, 1) and r.gap_to_leader is None and r._source == "openf1"


def test_reingest_is_idempotent(spark):
    """Ingesting the same landing files twice: the second run finds nothing new."""
    root = tempfile.mkdtemp(prefix="racelake-re-")
    res = {"MRData": {"total": "1", "RaceTable": {"season": "2024", "Races": [{
        "season": "2024", "round": "1", "Results": [{"position": "1", "grid": "1", "Driver": {"driverId": "max"},
                                                    "Constructor": {"constructorId": "rb"}}]}]}}}
    car = [{"session_key": 9, "driver_number": 1, "date": "2024-03-02T15:00:00.270Z", "speed": 200}]
    for folder, obj in [("results/results", res), ("timing/car_data", car)]:
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/p.json", "w") as f:
            f.write(json.dumps(obj) + "\n")
    wh = P.Warehouse(f"{root}/wh")
    P.ingest_landing(spark, root, wh, "2024-03-04 06:00:00")
    P.ingest_landing(spark, root, wh, "2024-03-05 06:00:00")
    stg = P.stage_all(spark, wh)
    assert stg["results"].count() == 1 and spark.read.parquet(wh.path("raw", "results")).count() == 1  # no new file
    assert stg["car_data"].count() == 1


def test_dashboard_sql_on_registered_marts(spark, warehouse):
    """The dashboard cards run as SQL over the registered marts."""
    views = P.register_marts(spark, warehouse)
    assert {"mart_standings", "fact_race_results", "mart_lap_telemetry", "dim_sessions"} <= set(views)
    final = spark.sql("""
        SELECT standing_position, driver_id, points FROM mart_standings
        WHERE season = 1999 AND round = (SELECT max(round) FROM mart_standings WHERE season = 1999)
        ORDER BY standing_position""").collect()
    assert final and final[0].standing_position == 1
    pod = spark.sql("""
        SELECT jolpica_driver_id AS driver, count_if(finish_position = 1) AS wins,
               count_if(finish_position <= 3) AS podiums
        FROM fact_race_results WHERE season = 1999 GROUP BY jolpica_driver_id""").collect()
    assert sum(r.wins for r in pod) > 0
    trace = spark.sql("SELECT date, speed FROM mart_lap_telemetry WHERE session_key = 9000 ORDER BY date")
    assert "PartitionFilters: [isnotnull(session_key" in trace._jdf.queryExecution().executedPlan().toString()


def test_late_laps_rebuild_their_session(spark):
    """Lap data landing after the samples still re-slices that session."""
    from tests.test_models import _telemetry_inputs
    car, laps, loc, dist = _telemetry_inputs(spark)
    at = lambda df, t: df.withColumn("_ingested_at", F.lit(t).cast("timestamp"))
    smap = spark.createDataFrame([(9, 2024, 1, "Race")], "session_key int, season int, round int, session_type string")
    od = spark.createDataFrame([], "session_key int, driver_number int, name_acronym string, team_name string, "
                                   "team_colour string")
    dm = spark.createDataFrame([], "jolpica_driver_id string, openf1_driver_number int, season int")
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-late-"))
    first_laps = at(laps.filter(F.col("lap_number") == 1), "2024-01-01 00:00:00")
    P.rebuild_telemetry(spark, wh, at(car, "2024-01-01 00:00:00"), M.lap_boundaries(first_laps),
                        at(loc, "2024-01-01 00:00:00"), at(dist, "2024-01-01 00:00:00"), smap, od, dm)
    read = lambda: {r.date: r.lap_number for r in spark.read.parquet(wh.path("marts", "lap_telemetry")).collect()}
    assert set(read().values()) == {1}
    all_laps = first_laps.unionByName(at(laps.filter(F.col("lap_number") == 2), "2024-01-02 00:00:00"))
    P.rebuild_telemetry(spark, wh, at(car, "2024-01-01 00:00:00"), M.lap_boundaries(all_laps),
                        at(loc, "2024-01-01 00:00:00"), at(dist, "2024-01-01 00:00:00"), smap, od, dm)
    assert set(read().values()) == {1, 2}


def _landing_weekend(root):
    """One small race weekend as landing pages for every endpoint."""
    drv = lambda d: {"driverId": d}
    con = lambda c: {"constructorId": c}
    race = {"season": "2024", "round": "1", "raceName": "Bahrain GP", "Circuit": {"circuitId": "bahrain"},
            "date": "2024-03-02", "url": "u"}
    results = [{"number": "1", "position": "1", "positionText": "1", "points": "25", "grid": "1", "laps": "3",
                "status": "Finished", "Driver": drv("max"), "Constructor": con("rb"), "Time": {"millis": "5400000"}},
               {"number": "44", "position": "2", "positionText": "2", "points": "18", "grid": "2", "laps": "3",
                "status": "Finished", "Driver": drv("ham"), "Constructor": con("merc")}]
    quali = [{"position": "1", "Driver": drv("max"), "Constructor": con("rb"), "Q1": "1:30.100", "Q3": "1:29.500"},
             {"position": "2", "Driver": drv("ham"), "Constructor": con("merc"), "Q1": "1:30.300"}]
    laps = [{"number": str(n), "Timings": [{"driverId": "max", "position": "1", "time": "1:35.000"},
                                          {"driverId": "ham", "position": "2", "time": "1:35.500"}]} for n in (1, 2, 3)]
    stops = [{"driverId": "max", "lap": "2", "stop": "1", "time": "15:10:00", "duration": "22.5"}]
    mr = lambda extra: {"MRData": {"total": "1", "RaceTable": {"season": "2024", "Races": [{**race, **extra}]}}}
    standings = {"MRData": {"total": "2", "StandingsTable": {"season": "2024", "StandingsLists": [{
        "season": "2024", "round": "1",
        "DriverStandings": [{"position": "1", "points": "25", "wins": "1", "Driver": drv("max"), "Constructors": [con("rb")]},
                            {"position": "2", "points": "18", "wins": "0", "Driver": drv("ham"), "Constructors": [con("merc")]}],
        "ConstructorStandings": [{"position": "1", "points": "25", "wins": "1", "Constructor": con("rb")},
                                 {"position": "2", "points": "18", "wins": "0", "Constructor": con("merc")}]}]}}}
    pages = {
        "results/races": mr({}), "results/results": mr({"Results": results}),
        "results/qualifying": mr({"QualifyingResults": quali}), "results/laps": mr({"Laps": laps}),
        "results/pitstops": mr({"PitStops": stops}), "results/sprint": mr({"SprintResults": []}),
        "results/driverstandings": standings, "results/constructorstandings": standings,
        "results/drivers": {"MRData": {"total": "2", "DriverTable": {"Drivers": [
            {"driverId": "max", "givenName": "Max", "familyName": "V", "permanentNumber": "33", "code": "VER"},
            {"driverId": "ham", "givenName": "Lewis", "familyName": "H", "permanentNumber": "44", "code": "HAM"}]}}},
        "results/constructors": {"MRData": {"total": "2", "ConstructorTable": {"Constructors": [
            {"constructorId": "rb", "name": "RB", "nationality": "AT", "url": "u"},
            {"constructorId": "merc", "name": "Merc", "nationality": "DE", "url": "u"}]}}},
        "results/circuits": {"MRData": {"total": "1", "CircuitTable": {"Circuits": [
            {"circuitId": "bahrain", "url": "u", "circuitName": "Bahrain", "Location": {
                "lat": "26.0", "long": "50.5", "locality": "Sakhir", "country": "Bahrain"}}]}}},
        "timing/sessions": [
            {"session_key": 91, "session_name": "Qualifying", "session_type": "Qualifying", "year": 2024, "meeting_key": 1,
             "date_start": "2024-03-01T16:00:00+00:00", "date_end": "2024-03-01T17:00:00+00:00", "location": "Sakhir"},
            {"session_key": 92, "session_name": "Race", "session_type": "Race", "year": 2024, "meeting_key": 1,
             "date_start": "2024-03-02T15:00:00+00:00", "date_end": "2024-03-02T17:00:00+00:00", "location": "Sakhir"}],
        "timing/drivers": [{"session_key": s, "driver_number": n, "name_acronym": a, "team_name": t, "team_colour": c,
                            "headshot_url": f"https://img/{a}.png"}
                           for s in (91, 92) for n, a, t, c in ((1, "VER", "RB", "3671C6"), (44, "HAM", "Merc", ""))],
        "timing/laps": [{"session_key": s, "driver_number": n, "lap_number": l,
                         "date_start": f"2024-03-0{1 if s == 91 else 2}T{16 if s == 91 else 15}:0{l}:00+00:00",
                         "lap_duration": d + l / 100, "is_pit_out_lap": l == 1, "duration_sector_1": 30.0}
                        for s in (91, 92) for n, d in ((1, 89.5), (44, 95.0)) for l in (1, 2, 3)],
        "timing/stints": [{"session_key": 92, "driver_number": n, "stint_number": 1, "lap_start": 1, "lap_end": 3,
                           "compound": "SOFT", "tyre_age_at_start": 0} for n in (1, 44)],
        "timing/car_data": [{"session_key": 92, "driver_number": 1, "date": f"2024-03-02T15:0{m}:{s:02d}.000Z",
                             "speed": 200 + s} for m in (0, 1, 2, 3) for s in (10, 40)],
        "timing/location": [{"session_key": 92, "driver_number": 1, "date": f"2024-03-02T15:0{m}:05.000Z",
                             "x": m, "y": 0, "z": 0} for m in (0, 1, 2, 3)],
    }
    for folder, obj in pages.items():
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/p.json", "w") as f:
            f.write(json.dumps(obj) + "\n")


def test_run_all_from_landing(spark):
    root = tempfile.mkdtemp(prefix="racelake-all-")
    _landing_weekend(f"{root}/landing")
    wh = P.Warehouse(f"{root}/wh")
    P.run_all(spark, f"{root}/landing", wh, "2024-03-04 06:00:00")
    read = lambda n: spark.read.parquet(wh.path("marts", n))
    bridge = {r.jolpica_driver_id: r.openf1_driver_number for r in spark.read.parquet(wh.path("raw", "driver_id_map")).collect()}
    assert bridge == {"max": 1, "ham": 44}
    fr = {r.jolpica_driver_id: r for r in read("fact_race_results").collect()}
    assert fr["max"].session_key == 92 and fr["max"].of1_fastest_lap_duration == 89.53
    fq = {r.driver_id: r for r in read("fact_qualifying").collect()}
    assert fq["max"].best_source_match == "matched" and fq["max"].best_lap_number == 2
    assert fq["ham"].best_source_match == "mismatch"
    qs = {r.driver_id: r for r in read("qualifying_summary").collect()}
    assert qs["max"].team_colour == "#3671C6" and qs["ham"].team_colour is None and qs["max"].race_name == "Bahrain GP"
    tel = read("lap_telemetry").orderBy("date").collect()
    # samples before the first lap start (15:00:xx) are sliced away
    assert [r.lap_number for r in tel] == [1, 1, 2, 2, 3, 3] and tel[0].driver_id == "max"
    assert read("standings").count() == 2 and read("strategy").count() == 2
    dims = {r.circuit_id: (r.length_km, r.corners) for r in read("dim_circuits").collect()}
    assert dims == {"bahrain": (5.412, 15)}


def test_append_unseen_repair_replaces_only_chosen_rounds(spark):
    path = tempfile.mkdtemp(prefix="racelake-fact-") + "/fact"
    v1 = spark.createDataFrame([(2024, 1, "a", 1.0), (2024, 2, "a", 2.0)], "season int, round int, d string, p double")
    P.append_unseen(spark, v1, path)
    P.append_unseen(spark, v1, path)                                   # re-run: nothing appended
    v2 = spark.createDataFrame([(2024, 1, "a", 1.0), (2024, 2, "a", 9.0), (2024, 3, "a", 3.0)],
                               "season int, round int, d string, p double")
    P.append_unseen(spark, v2, path, repair=spark.createDataFrame([(2024, 2)], "season int, round int"))
    got = sorted((r.round, r.p) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1.0), (2, 9.0), (3, 3.0)]


def test_load_season_status(spark):
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-season-"))
    t = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b"), (2023, 9, "c")], "season int, round int, v string")
    st = P.load_weekend_status(spark, wh, {"results": t}, 2024)
    assert [r.status for r in st.collect()] == ["ok"]
    assert spark.read.parquet(wh.path("raw", "results")).count() == 2


def _car_page(k, d, second, speed):
    return [{"session_key": k, "driver_number": d, "date": f"2024-03-02T15:00:{second:02d}.000Z", "speed": speed}]


def test_old_files_are_never_opened_again(spark):
    """What a file holds after it was taken in is never read."""
    root = tempfile.mkdtemp(prefix="racelake-log-")
    wh = P.Warehouse(f"{root}/wh")
    _page(root, "timing/car_data", "a.json", _car_page(9, 1, 1, 201))
    _page(root, "timing/weather", "a.json", [{"session_key": 9, "date": "2024-03-02T15:00:00+00:00", "air_temperature": 20.5}])
    assert P.ingest_landing(spark, root, wh) == ["weather", "car_data"]
    _page(root, "timing/car_data", "a.json", "no page any more {")
    _page(root, "timing/car_data", "b.json", _car_page(9, 1, 2, 202))
    os.utime(f"{root}/timing/car_data/b.json", (1_000_000_000, 1_000_000_000))  # years older than the first file
    assert P.ingest_landing(spark, root, wh) == ["car_data"]
    assert P.ingest_landing(spark, root, wh) == []
    rows_ = spark.read.parquet(wh.path("raw", "car_data")).collect()
    assert sorted(r.speed for r in rows_) == [201, 202] and len({r["_batch_id"] for r in rows_}) == 2
    assert P.rejects(spark, wh).count() == 0


def test_batch_and_stream_share_log_and_layout(spark):
    from racelake.streaming.ingest import stream_telemetry
    from tests.test_models import _telemetry_inputs
    _, laps, loc, dist = _telemetry_inputs(spark)
    stamp = lambda df: df.withColumn("_ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    smap = spark.createDataFrame([(9, 2024, 1, "Race")], "session_key int, season int, round int, session_type string")
    od = spark.createDataFrame([], "session_key int, driver_number int, name_acronym string, team_name string, team_colour string")
    dm = spark.createDataFrame([], "jolpica_driver_id string, openf1_driver_number int, season int")
    root = tempfile.mkdtemp(prefix="racelake-both-")
    wh = P.Warehouse(f"{root}/wh")
    stream = lambda ck=None: stream_telemetry(
        spark, f"{root}/timing/car_data", wh, ck, M.lap_boundaries(laps), stamp(loc), stamp(dist), smap, od, dm)
    speeds = lambda: sorted(r.speed for r in spark.read.parquet(wh.path("raw", "car_data")).collect())
    _page(root, "timing/car_data", "a.json", _car_page(9, 1, 1, 201))
    P.ingest_landing(spark, root, wh)
    _page(root, "timing/car_data", "b.json", _car_page(9, 1, 2, 202))
    stream()
    assert speeds() == [201, 202]
    P.ingest_landing(spark, root, wh)                                   # nothing is left for the batch load
    assert speeds() == [201, 202]
    _page(root, "timing/car_data", "c.json", _car_page(8, 1, 3, 203))
    P.ingest_landing(spark, root, wh)
    stream()
    assert speeds() == [201, 202, 203]
    stream(f"{root}/other-checkpoint")                                  # a log of its own: labels never meet
    assert speeds() == [201, 201, 202, 202, 203, 203]
    assert _samples(spark, wh) == 3
    assert any(d.startswith("year=2024") for d in os.listdir(wh.path("raw", "car_data")))


def _samples(spark, wh):
    from racelake.plans.staging import one_per_sample
    return one_per_sample(P.stage_all(spark, wh)["car_data"]).count()


def test_a_batch_run_again_replaces_itself(spark):
    from racelake.streaming.ingest import raw_writer
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-again-"))
    write = raw_writer(wh, "car_data", O.parse_car_data, telemetry=True)
    page = lambda rows_: spark.createDataFrame([(json.dumps(r), "f") for r in rows_], "json string, file string")
    write(page([_car_page(9, 1, 1, 1), _car_page(8, 1, 1, 2)]), "b0")
    write(page([_car_page(9, 1, 2, 3)]), "b1")
    write(page([_car_page(9, 1, 1, 1), _car_page(8, 1, 1, 2)]), "b0")
    assert sorted(r.speed for r in spark.read.parquet(wh.path("raw", "car_data")).collect()) == [1, 2, 3]
    assert P.rejects(spark, wh).count() == 0


def test_rows_with_an_equal_or_older_stamp_are_news(spark):
    """What is new is told by batches, not by clocks."""
    root = tempfile.mkdtemp(prefix="racelake-stamp-")
    wh = P.Warehouse(f"{root}/wh")
    laps = spark.createDataFrame([(k, 1, 1, dt.datetime(2024, 3, 2, 15), 0) for k in (7, 8, 9)],
                                 "session_key int, driver_number int, lap_number int, lap_start timestamp, is_pit_out_lap int")
    smap = spark.createDataFrame([(9, 2024, 1, "Race")], "session_key int, season int, round int, session_type string")
    od = spark.createDataFrame([], "session_key int, driver_number int, name_acronym string, team_name string, team_colour string")
    dm = spark.createDataFrame([], "jolpica_driver_id string, openf1_driver_number int, season int")

    def run(stamp):
        P.ingest_landing(spark, root, wh, stamp)
        stg = P.stage_all(spark, wh)
        return P.rebuild_telemetry(spark, wh, stg["car_data"], M.lap_boundaries(laps), stg["location"], stg["distances"], smap, od, dm)
    _page(root, "timing/car_data", "a.json", _car_page(9, 1, 1, 1))
    assert run("2024-03-04 06:00:00") == 1
    _page(root, "timing/car_data", "b.json", _car_page(8, 1, 1, 2))
    assert run("2024-03-04 06:00:00") == 1                              # equal
    _page(root, "timing/car_data", "c.json", _car_page(7, 1, 1, 3))
    assert run("2020-01-01 00:00:00") == 1                              # older
    assert run("2024-03-05 06:00:00") == 0
    assert spark.read.parquet(wh.path("marts", "lap_telemetry")).count() == 3


def test_small_sessions_are_one_file(spark):
    path = tempfile.mkdtemp(prefix="racelake-files-") + "/t"
    df = spark.range(40_000).select((F.col("id") % 3).cast("int").alias("session_key"), (F.col("id") % 20).cast("int").alias("driver_number"),
                                    F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("date"), F.lit(1).alias("speed")).repartition(8)
    O.write_telemetry(df, path)
    files = [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2 * 3
    assert spark.read.parquet(path).count() == 40_000


def test_results_without_a_timing_feed(spark):
    """A season that only the results feed knows builds all marts it can."""
    root = tempfile.mkdtemp(prefix="racelake-results-")
    _landing_weekend(f"{root}/all")
    os.makedirs(f"{root}/landing")
    os.symlink(f"{root}/all/results", f"{root}/landing/results")
    wh = P.Warehouse(f"{root}/wh")
    P.run_all(spark, f"{root}/landing", wh, "2024-03-04 06:00:00")
    fr = {r.jolpica_driver_id: r for r in spark.read.parquet(wh.path("marts", "fact_race_results")).collect()}
    assert set(fr) == {"max", "ham"} and fr["max"].session_key is None
    fq = spark.read.parquet(wh.path("marts", "fact_qualifying")).collect()
    assert {r.best_source_match for r in fq} == {"jolpica_only"}
    assert spark.read.parquet(wh.path("marts", "fact_laps")).count() == 6
    assert spark.read.parquet(wh.path("marts", "dim_sessions")).count() == 0


def test_corrected_rounds_are_found_by_their_digests(spark):
    """A corrected round is replaced, a new one added, a withdrawn one removed; others stay."""
    wh = P.Warehouse(tempfile.mkdtemp(prefix="racelake-digest-"))
    make = lambda rows_, at="2024-01-01": spark.createDataFrame(
        [(*r, at) for r in rows_], "season int, round int, d string, p double, _ingested_at string")
    run = lambda src, timing=None: P.build_fact(spark, wh, "f", src.drop("_ingested_at"),
                                                {"results": src, **({} if timing is None else {"timing": timing})})
    got = lambda: sorted((r.season, r.round, r.d, r.p) for r in spark.read.parquet(wh.path("marts", "f")).collect())
    rows_ = [(2023, 1, "a", 1.0), (2023, 1, "b", 1.5), (2024, 1, "a", 2.0), (2024, 2, "a", 3.0)]
    run(make(rows_))
    assert got() == rows_
    files = lambda: {f for d, _, fs in os.walk(wh.path("marts", "f")) for f in fs if "season=2023" in d}
    before = files()
    run(make(rows_, "2024-02-02"))                                      # fetched again, unchanged
    fixed = [*rows_[:3], (2024, 2, "a", 9.0), (2024, 3, "a", 4.0)]
    run(make(fixed))
    assert got() == fixed and files() == before
    run(make(fixed[:4]))                                                # round 3 is withdrawn
    assert got() == fixed[:4]
    # rows of another source that arrive later mark their round too
    timing = make([(2024, 1, "t", 0.0)])
    changes = P.Digests(spark, wh, "f").changes({"results": make(fixed[:4]), "timing": timing})
    assert [(r.season, r.round, r.source) for r in changes.collect()] == [(2024, 1, "timing")]


def test_timing_that_comes_later_reaches_the_facts(spark):
    """Results first, the timing feed in a later run: the loaded rounds get their sessions."""
    root = tempfile.mkdtemp(prefix="racelake-later-")
    _landing_weekend(f"{root}/all")
    os.makedirs(f"{root}/landing")
    os.symlink(f"{root}/all/results", f"{root}/landing/results")
    wh = P.Warehouse(f"{root}/wh")
    P.run_all(spark, f"{root}/landing", wh, "2024-03-04 06:00:00")
    os.symlink(f"{root}/all/timing", f"{root}/landing/timing")
    P.run_all(spark, f"{root}/landing", wh, "2024-03-04 07:00:00")
    fr = {r.jolpica_driver_id: r for r in spark.read.parquet(wh.path("marts", "fact_race_results")).collect()}
    assert len(fr) == 2 and fr["max"].session_key == 92 and fr["max"].of1_fastest_lap_duration == 89.53
    assert spark.read.parquet(wh.path("marts", "fact_laps")).count() == 6


def test_work_list(spark):
    from racelake.plans import worklist as W
    root = tempfile.mkdtemp(prefix="racelake-work-")
    wh = P.Warehouse(f"{root}/wh")
    _page(root, "timing/sessions", "a.json", [
        {"session_key": k, "session_name": t, "session_type": t, "year": 2024, "meeting_key": 1,
         "date_start": f"{day}T15:00:00+00:00", "date_end": f"{day}T16:15:00+00:00"}
        for k, t, day in ((1, "Race", "2024-03-02"), (2, "Practice 1", "2024-03-01"), (3, "Race", "2030-03-02"))])
    _page(root, "timing/weather", "a.json", [{"session_key": 1, "date": "2024-03-02T15:00:00+00:00"}])
    car = lambda minute: [{"session_key": 1, "driver_number": 1, "date": f"2024-03-02T15:{minute:02d}:00.000Z", "speed": 1}]
    _page(root, "timing/car_data", "a.json", car(5))
    P.ingest_landing(spark, root, wh)
    owed = W.units(P.stage_all(spark, wh)["sessions"], "2025-01-01 00:00:00")
    per = {(r.session_key, r.feed): r["count"] for r in owed.groupBy("session_key", "feed").count().collect()}
    assert per[1, "car_data"] == 3 and per[2, "weather"] == 1 and (2, "car_data") not in per and 3 not in {k for k, _ in per}
    work = W.WorkList(spark, wh)
    assert work.pending(owed).count() == owed.count()
    work.check(owed, 1)
    done = lambda: sorted((r.session_key, r.feed, r.window_start.minute) for r in work.status().filter("status = 'done'").collect())
    assert done() == [(1, "car_data", 0), (1, "weather", 0)]
    _page(root, "timing/car_data", "b.json", car(40))
    P.ingest_landing(spark, root, wh)
    work.check(owed, 2)
    assert done() == [(1, "car_data", 0), (1, "car_data", 30), (1, "weather", 0)]
    left = {(r.session_key, r.feed, r.window_start.hour): r.attempts for r in work.pending(owed).collect()}
    assert left[1, "car_data", 16] == 2 and left[2, "weather", 15] == 2 and work.pending(owed).count() == owed.count() - 3


def test_load_exactly_one_session(spark):
    from racelake.plans import worklist as W
    root = tempfile.mkdtemp(prefix="racelake-one-")
    _landing_weekend(f"{root}/landing")
    wh = P.Warehouse(f"{root}/wh")
    at = "2025-01-01 00:00:00"
    load = lambda k, **kw: {r.feed: r.status for r in W.load_session(spark, f"{root}/landing", wh, k, **{"as_of": at, **kw}).collect()}
    assert set(load(92).values()) == {"skipped"}                        # not a known session yet
    P.ingest_landing(spark, f"{root}/landing", wh, tables=["sessions"])
    assert set(load(92, as_of="2024-03-02 16:00:00").values()) == {"skipped"}   # not over yet
    st = load(92)
    assert st["of1_laps"] == st["car_data"] == "loaded" and st["weather"] == "absent"
    load(92)
    assert spark.read.parquet(wh.path("raw", "car_data")).count() == 8
    laps = spark.read.parquet(wh.path("raw", "of1_laps"))
    assert laps.count() == 6 and {r.session_key for r in laps.collect()} == {92}
    st = load(91, skip_telemetry=True)
    assert st["car_data"] == "skipped" and st["of1_laps"] == "loaded"
