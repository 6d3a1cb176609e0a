"""Bucketed telemetry feeds: no exchange over the samples, loads, compaction."""

import datetime as dt
import os
import re
import tempfile

from pyspark.sql import functions as F

from racelake.contract.inputs import Inputs
from racelake.operators.asof import AsofRight, asof_join_many
from racelake.plans import models as M
from racelake.plans.staging import one_per_sample
from racelake.sources.buckets import compact, in_buckets, read_buckets, write_buckets

SF = "/root/testdata/sf0.001"


def _files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def _feeds(spark, root, n):
    i = Inputs(spark, SF)
    feeds = {"car": i.car().drop("event_id"), "location": i.location(), "distance": i.distance()}
    for name, df in feeds.items():
        write_buckets(df.withColumn("_ingested_at", F.lit("2024-02-01 00:00:00").cast("timestamp")), f"{root}/{name}", n)
    return i, {name: read_buckets(spark, f"{root}/{name}", n) for name in feeds}


def test_asof_over_buckets_has_no_exchange(spark):
    root = tempfile.mkdtemp(prefix="racelake-buckets-")
    _, feeds = _feeds(spark, root, 8)
    feeds = {n: one_per_sample(df) for n, df in feeds.items()}
    out = asof_join_many(feeds["car"], M.TELEMETRY_KEYS, "date",
                         [AsofRight(feeds["location"], "date", ["x", "y"]), AsofRight(feeds["distance"], "date", ["distance_m"])],
                         keep_unmatchable=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 3 and "Exchange" not in plan


def test_mart_shuffles_laps_and_dimensions_only(spark):
    root = tempfile.mkdtemp(prefix="racelake-buckets-")
    i, feeds = _feeds(spark, root, 8)
    sm = M.session_map(i.sample_sessions(), i.sample_races())
    out = M.lap_telemetry_from_buckets(feeds, 8, i.lap_starts(), sm, i.sample_drivers(), i.sample_driver_map())
    core = M.lap_telemetry_core(feeds["car"], in_buckets(M.lap_boundaries(i.lap_starts()), 8), feeds["location"], feeds["distance"])
    text = core._jdf.queryExecution().executedPlan().toString()
    assert text.count("Bucketed: true") == 3
    # exchanges: the lap bounds' window and their way into the buckets, both below the union
    above = text.split("Union")[0]
    assert "Exchange" not in above and len(re.findall("Exchange hashpartitioning", text)) == 2
    want = M.lap_telemetry(i.car(), M.lap_boundaries(i.lap_starts()), i.location(), i.distance(), sm, i.sample_drivers(), i.sample_driver_map())
    key = ["session_key", "driver_number", "date", "lap_number", "x", "distance_m", "gps_updated", "driver_id"]
    assert sorted(map(str, out.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_loads_and_compaction(spark):
    root = tempfile.mkdtemp(prefix="racelake-buckets-")
    at = lambda s: dt.datetime(2024, 3, 2, 15, 0, s)
    schema = "session_key int, driver_number int, date timestamp, speed int, _ingested_at timestamp"
    write_buckets(spark.createDataFrame([(1, 1, at(1), 10, at(0)), (1, 2, at(1), 20, at(0)), (None, 2, at(1), 0, at(0)), (1, 2, None, 0, at(0))], schema),
                  f"{root}/car", 4)
    write_buckets(spark.createDataFrame([(1, 1, at(1), 11, at(5)), (2, 1, at(1), 30, at(5))], schema), f"{root}/car", 4)
    assert sorted(r.speed for r in read_buckets(spark, f"{root}/car", 4).collect()) == [10, 11, 20, 30]
    compact(spark, f"{root}/car", f"{root}/compact", 4)
    assert sorted(r.speed for r in read_buckets(spark, f"{root}/compact", 4).collect()) == [11, 20, 30]
    assert len(_files(f"{root}/compact")) <= 4
    write_buckets(spark.createDataFrame([], schema), f"{root}/compact", 4)
    assert read_buckets(spark, f"{root}/compact", 4).count() == 3
