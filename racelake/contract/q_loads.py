"""Contract queries of the load rules I4, I5, I8, I9, I10 and of the data-test suite."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from racelake import fixtures as fx
from racelake.contract.inputs import Inputs
from racelake.contract.q_models import TELEMETRY_SQL
from racelake.contract.q_sources import _flat_pages, _iso
from racelake.contract.registry import query
from racelake.contract.sqlgen import oracle
from racelake.operators.incremental import overwrite_partitions, write_append
from racelake.plans import data_tests as DT
from racelake.plans import models as M
from racelake.plans import pipeline as P
from racelake.session import scratch_path


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("partition_overwrite", oracle("""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0.0 ELSE CAST(o_totalprice AS DOUBLE) END AS price FROM orders"""))
def q_partition_overwrite(spark, sf):
    """I4: a second write replaces the partitions it holds and no others."""
    path = _scratch(spark, "overwrite")
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    overwrite_partitions(o, path, ["o_orderstatus"])
    overwrite_partitions(o.filter("o_orderstatus = 'F'").withColumn("price", F.lit(0.0)), path, ["o_orderstatus"])
    return spark.read.schema(o.schema).parquet(path)


@query("full_refresh", oracle("SELECT c_custkey, c_nationkey FROM customer"))
def q_full_refresh(spark, sf):
    """Writing a table anew leaves exactly the new rows."""
    path = _scratch(spark, "refresh")
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    P.materialise(c.filter("c_custkey % 2 = 0"), path)
    P.materialise(c, path, sort_by=["c_custkey"])
    return spark.read.parquet(path)


@query("schema_evolution", oracle("""
SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE CAST(s_nationkey AS INTEGER) END AS region_code FROM supplier"""))
def q_schema_evolution(spark, sf):
    """I8: files written before a column existed read as its default."""
    path = _scratch(spark, "evolve")
    s = fx.table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("region_code"))
    write_append(s.filter("s_suppkey % 2 = 0").drop("region_code"), path)
    write_append(s.filter("s_suppkey % 2 = 1"), path)
    return P.ensure_columns(P.read_evolving(spark, path), {"region_code": ("int", 0)})


@query("bulk_append", oracle("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem"))
def q_bulk_append(spark, sf):
    """Appended batches, one of them empty, are all there."""
    path = _scratch(spark, "append")
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    for part in ("l_linenumber <= 2", "false", "l_linenumber > 2"):
        write_append(li.filter(part), path)
    return spark.read.parquet(path)


@query("weekend_load", oracle("""
SELECT 'results' AS feed, count(*) AS n FROM fx_results WHERE season = 1999 AND round = 6
UNION ALL SELECT 'laps' AS feed, count(*) AS n FROM fx_lap_times WHERE season = 1999 AND round = 6
UNION ALL SELECT 'stops' AS feed, count(*) AS n FROM fx_pit_stops WHERE season = 1999 AND round = 6"""))
def q_weekend_load(spark, sf):
    """Every results-feed table reduced to one race weekend."""
    i = Inputs(spark, sf)
    got = P.load_weekend({"results": i._l("fx_results"), "laps": i._l("fx_lap_times"), "stops": i._l("fx_pit_stops")}, 1999, 6)
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("feed"), "n") for k, df in got.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("data_test_suite", oracle("""
WITH laps AS (SELECT driver_id, CASE WHEN lap_number % 7 = 0 THEN NULL ELSE lap_number END AS lap_number FROM fx_lap_times)
SELECT 'not_null:fact_laps.driver_id' AS test, count(*) FILTER (WHERE driver_id IS NULL) AS n_failing FROM laps
UNION ALL SELECT 'not_null:fact_laps.lap_number', count(*) FILTER (WHERE lap_number IS NULL) FROM laps
UNION ALL SELECT 'not_null:dim_constructors.constructor_id', 0
UNION ALL SELECT 'unique:dim_constructors.constructor_id', count(*) FROM (
  SELECT constructor_id FROM (SELECT constructor_id FROM fx_constructors UNION ALL
    SELECT constructor_id FROM fx_constructors WHERE constructor_name LIKE '%1') d GROUP BY 1 HAVING count(*) > 1) e
UNION ALL SELECT 'accepted:sessions.session_type', count(DISTINCT session_name) FROM fx_sessions
  WHERE session_name NOT IN ('Race', 'Qualifying')"""))
def q_data_test_suite(spark, sf):
    """The suite on tables with planted failures."""
    i = Inputs(spark, sf)
    laps = i._l("fx_lap_times").select("driver_id", F.expr("CASE WHEN lap_number % 7 = 0 THEN NULL ELSE lap_number END").alias("lap_number"))
    cons = i._l("fx_constructors")
    sessions = i._l("fx_sessions").select(F.col("session_name").alias("session_type"))
    tables = {"fact_laps": laps, "dim_constructors": cons.unionByName(cons.filter("constructor_name LIKE '%1'")), "sessions": sessions}
    suite = [t for t in DT.SUITE if t.kind != "accepted"] + [DT.Test("sessions", "session_type", "accepted", values=("Race", "Qualifying"))]
    return DT.run_data_tests(spark, tables, suite).select("test", "n_failing")


def _land(folder, car, laps, location, distance):
    """Landing pages of four feeds, added to what lies there."""
    keys = ["session_key", "driver_number"]
    at = _iso(F.col("date")).alias("date")
    feeds = {
        "car_data": _flat_pages(car, keys, F.struct(*keys, at, "rpm", "speed", "n_gear", "throttle", "brake", "drs")),
        "location": _flat_pages(location, keys, F.struct(*keys, at, "x", "y", "z")),
        "laps": _flat_pages(laps, ["session_key"], F.struct(*keys, "lap_number", _iso(F.col("lap_start")).alias("date_start"),
                                                            "lap_duration", (F.col("is_pit_out_lap") == 1).alias("is_pit_out_lap"))),
    }
    for name, pages in feeds.items():
        pages.write.mode("append").text(f"{folder}/timing/{name}")
    samples = F.collect_list(F.struct(_iso(F.col("date")).alias("Date"), F.col("distance_m").alias("Distance"))).alias("samples")
    (distance.groupBy(*keys).agg(samples).select(F.to_json(F.struct(*keys, "samples")).alias("value"))
     .write.mode("append").text(f"{folder}/distance/samples"))


@query("ingest_log", oracle(f"SELECT * FROM {TELEMETRY_SQL} t").replace("ts AS date", "date_trunc('millisecond', ts) AS date"))
def q_ingest_log(spark, sf):
    """Pages of four feeds land in two rounds.  The first is taken in
    by the batch load, the second partly by the stream, over one log and one layout; the
    telemetry mart follows each.  Equals the one-shot build over all samples."""
    from racelake.streaming.ingest import stream_telemetry
    i = Inputs(spark, sf)
    root = _scratch(spark, "ingest-log")
    wh, landing = P.Warehouse(f"{root}/wh"), f"{root}/landing"
    smap = M.session_map(i.sample_sessions(), i.sample_races())
    drivers, numbers = i.sample_drivers(), i.sample_driver_map()
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    laps = i.lap_starts().withColumn("date", F.col("lap_start"))
    others = ["of1_laps", "location", "car_telemetry"]
    feeds = [i.car(), laps, i.location(), i.distance()]

    _land(landing, *[df.filter(F.col("date") < middle) for df in feeds])
    P.ingest_landing(spark, landing, wh, "2024-02-01 00:00:00", tables=["car_data", *others])
    stg = P.stage_all(spark, wh)
    P.rebuild_telemetry(spark, wh, stg["car_data"], M.lap_boundaries(stg["laps"]), stg["location"], stg["distances"],
                        smap, drivers, numbers)
    _land(landing, *[df.filter(F.col("date") >= middle) for df in feeds])
    P.ingest_landing(spark, landing, wh, "2024-02-01 00:00:00", tables=others)  # the very same ingest time
    stg = P.stage_all(spark, wh)
    stream_telemetry(spark, f"{landing}/timing/car_data", wh, None, M.lap_boundaries(stg["laps"]), stg["location"],
                     stg["distances"], smap, drivers, numbers)
    out = spark.read.parquet(wh.path("marts", "lap_telemetry"))
    return out.drop("_ingested_at", "year").withColumn("session_key", F.col("session_key").cast("long"))


@query("work_list", oracle("""
WITH s AS (SELECT session_key, session_type, date_start, date_end FROM fx_stg_sessions WHERE date_end < TIMESTAMP '2000-06-01 00:00:00'),
owed AS (
  SELECT session_key, f.feed, date_start AS window_start, date_end AS window_end
  FROM s, (VALUES ('of1_laps'), ('pit'), ('stints'), ('intervals'), ('weather'), ('race_control')) f(feed)
  UNION ALL
  SELECT session_key, f.feed, w AS window_start, least(w + INTERVAL 30 MINUTE, date_end) AS window_end
  FROM (SELECT *, unnest(generate_series(date_start, date_end, INTERVAL 30 MINUTE)) AS w FROM s WHERE session_type IN ('Race', 'Qualifying')) c,
       (VALUES ('car_data'), ('location')) f(feed) WHERE w < date_end)
SELECT session_key, feed, window_start, window_end, CASE WHEN feed = 'stints' AND session_key IN (SELECT session_key FROM fx_stints) THEN 1 ELSE 0 END AS done
FROM owed"""))
def q_work_list(spark, sf):
    """Units owed by the finished sessions, checked after the stints were loaded."""
    from racelake.plans import worklist as W
    i = Inputs(spark, sf)
    wh = P.Warehouse(_scratch(spark, "worklist"))
    i.stints().write.parquet(wh.path("raw", "stints"))
    owed = W.units(i.sessions(), "2000-06-01 00:00:00")
    owed = owed.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    work = W.WorkList(spark, wh)
    work.check(owed, 1)
    state = work.status().select("session_key", "feed", "window_start", (F.col("status") == "done").cast("int").alias("done"))
    return owed.join(state, W.UNIT)


@query("changed_rounds", oracle("""
SELECT season, round, source FROM (
  SELECT DISTINCT CAST(season AS BIGINT) AS season, CAST(round AS BIGINT) AS round, 'results' AS source FROM fx_results_full WHERE points >= 25
  UNION SELECT DISTINCT season, round, 'stops' FROM fx_pit_stops WHERE stop_number = 3) c"""))
def q_changed_rounds(spark, sf):
    """Rounds whose source rows have changed since the last run, by digests: results of
    winners corrected, third stops withdrawn."""
    i = Inputs(spark, sf)
    digests = P.Digests(spark, P.Warehouse(_scratch(spark, "digests")), "fact")
    results, stops = i.results(), i.pit_stops()
    digests.commit(digests.changes({"results": results, "stops": stops}), 1)
    fixed = results.withColumn("status", F.when(F.col("points") >= 25, "corrected").otherwise(F.col("status")))
    return digests.changes({"results": fixed, "stops": stops.filter("stop_number <> 3")}).select("season", "round", "source")
