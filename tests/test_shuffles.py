"""Laps are moved between tasks as seldom, and as narrow, as the job allows."""

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from racelake import contract
from racelake import fixtures as fx
from racelake.contract import q_sources as QS
from racelake.plans import models as M

ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
LINES = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz, "
         "l_returnflag string")


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders twice, without customer or date; lines twice, without order, part or price."""
    at = tmp_path_factory.mktemp("sf")
    day = dt.datetime(1999, 6, 3)
    orders = [(k, k % 7, dt.datetime(1998 + k % 2, 1 + k % 12, 1 + k % 28)) for k in range(60)]
    orders += [(3, 3, orders[3][2]), (5, 6, day), (70, None, day), (71, 4, None), (None, 1, day)]
    lines = [(k % 72, 1 + k // 72, 10 + k % 11, 5 + k % 3, 100.25 * k, day + dt.timedelta(days=k % 5), "R") for k in range(300)]
    lines += [lines[9], lines[9][:5] + (None, "N"), (4, None, 1, 1, 5.5, day, "N"), (4, 2, None, 1, None, day, "N"), (None, 1, 1, 1, 1.0, day, "N")]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{at}/lineitem.parquet")
    return str(at)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lap_times_are_those_of_the_adapter(spark, sf):
    got = Counter(tuple(r) for r in fx.load(spark, sf, "fx_lap_times").collect())
    want = Counter(tuple(r) for r in fx.sql_frame(spark, sf, "fx_lap_times").collect())
    assert got == want and sum(got.values()) > 250


def test_lap_times_leave_what_does_not_matter(spark):
    assert "l_shipdate" not in fx.SPARK_FORMS["fx_lap_times"]


def test_session_dates_come_by_broadcast(spark, sf):
    fx.load(spark, sf, "fx_stg_laps")
    ctes = ", ".join(f"{d} AS (SELECT * FROM parquet.`{fx.materialise(spark, sf, d)}`)" for d in ("fx_timing_laps", "fx_sessions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(spark.sql(f"WITH {ctes} {fx.SPARK_FORMS['fx_stg_laps']}"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_are_cut_without_a_shuffle(spark):
    rows = [(k // 250 if k < 500 else None, k, None if k % 3 else 0.5, [k, None]) for k in range(520)]
    df = spark.createDataFrame(rows, "s long, n long, x double, a array<int>").coalesce(1)
    pages = QS._flat_pages(df, ["s"], F.struct("s", "n", "x", "a"))
    assert "Exchange" not in plan(pages)
    read = [json.loads(r["json"]) for r in pages.collect()]
    assert all(0 < len(p) <= QS.PAGE_SIZE and len({o.get("s") for o in p}) == 1 for p in read)
    assert max(map(len, read)) == QS.PAGE_SIZE
    got = [(o.get("s"), o["n"], o.get("x"), o["a"]) for p in read for o in p]
    assert sorted(got, key=lambda r: r[1]) == rows


def test_timing_laps_are_staged_in_one_pass(spark, sf):
    df = contract.QUERIES["src_array_compact"](spark, sf)
    assert "Join" not in plan(df) and plan(df).count("Exchange hashpartitioning") == 1
    assert df.count() == fx.load(spark, sf, "fx_stg_laps").filter("lap_number % 13 <> 0").count()


def test_laps_of_other_sessions_stay_out_of_the_join(spark):
    laps = spark.createDataFrame([(1999, 1, "d1", n, 1, "1:00.000", 60000) for n in (1, 2)] + [(1999, 1, "d2", 1, 1, "1:01.000", 61000)],
                                 "season int, round int, driver_id string, lap_number int, lap_position int, lap_time string, lap_time_ms long")
    numbers = spark.createDataFrame([("d1", 4, 1999)], "jolpica_driver_id string, openf1_driver_number int, season int")
    smap = spark.createDataFrame([(13, 1999, 1, "Race"), (11, 1999, 1, "Qualifying"), (23, 1999, 2, "Race")],
                                 "session_key long, season int, round int, canonical_type string")
    timed = spark.createDataFrame([(s, 4, 1, 60.0, 0) + (1.0, 2.0, 3.0, 4, 5, 6) for s in (11, 13, 23)],
                                  "session_key long, driver_number int, lap_number int, lap_duration double, is_pit_out_lap int, "
                                  "duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, i1_speed int, i2_speed int, st_speed int")
    out = M.fact_laps(laps, numbers, smap, timed)
    assert "LeftSemi" in plan(out)
    got = {(r["driver_id"], r["lap_number"]): (r["session_key"], r["of1_lap_duration"]) for r in out.collect()}
    assert got == {("d1", 1): (13, 60.0), ("d1", 2): (13, None), ("d2", 1): (13, None)}


def test_lap_times_report_reads_its_race_alone(spark, sf):
    text = plan(contract.QUERIES["rep_lap_times"](spark, sf))
    scans = [line for line in text.splitlines() if "FileScan" in line and "lap_time_ms#" in line]
    assert len(scans) >= 3 and all("EqualTo(season,1999)" in line for line in scans)
