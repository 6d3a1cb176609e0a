"""Contract queries for the data-quality checks D1-D7 (failing rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from racelake import fixtures as fx
from racelake.contract.inputs import Inputs
from racelake.contract.q_models import FACT_QUALI_SQL
from racelake.contract.registry import query
from racelake.contract.sqlgen import oracle
from racelake.plans import models as M
from racelake.plans import quality as Q

# Accepted timing-feed session types.
SESSION_TYPES = ["Race", "Qualifying", "Sprint", "Sprint Qualifying",
                 "Practice", "Practice 1", "Practice 2", "Practice 3"]


@query("dq_not_null", oracle(f"""
SELECT season, round, driver_id, best_lap_number FROM {FACT_QUALI_SQL} f WHERE best_lap_number IS NULL"""))
def q_not_null(spark, sf):
    """Qualifying rows without a matched timing lap."""
    i = Inputs(spark, sf)
    fq = M.fact_qualifying(i.quali(), i.driver_map(), M.session_map(i.sessions(), i.races()), i.of1_laps())
    return Q.not_null(fq, "best_lap_number").select("season", "round", "driver_id", "best_lap_number")


@query("dq_unique", oracle("""
SELECT session_key, driver_number, count(*) AS n FROM fx_timing_drivers
GROUP BY session_key, driver_number HAVING count(*) > 1"""))
def q_unique(spark, sf):
    """Re-ingested timing-driver rows."""
    return Q.unique(Inputs(spark, sf).of1_drivers(), ["session_key", "driver_number"])


@query("dq_relationships", oracle("""
SELECT r.season, r.round, r.driver_id, r.constructor_id FROM fx_results r
WHERE r.constructor_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM fx_constructors c WHERE c.constructor_id = r.constructor_id AND c.constructor_name NOT LIKE '%1')"""))
def q_relationships(spark, sf):
    """D3: results whose constructor is missing from a constructor table with gaps."""
    i = Inputs(spark, sf)
    r = i._l("fx_results").select("season", "round", "driver_id", "constructor_id")
    parents = i._l("fx_constructors").filter(~F.col("constructor_name").like("%1"))
    return Q.relationships(r, "constructor_id", parents, "constructor_id")


@query("dq_accepted_values", oracle("""
SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup') OR event_type IS NULL"""))
def q_accepted_values(spark, sf):
    """D4 on the event stream (sample kinds the telemetry views consume)."""
    return Q.accepted_values(fx.table(spark, sf, "events"), "event_type", ["view", "click", "purchase", "signup"])


@query("dq_accepted_session_types", oracle(f"""
SELECT DISTINCT session_type FROM fx_stg_sessions
WHERE session_type NOT IN ({", ".join(repr(t) for t in SESSION_TYPES)}) OR session_type IS NULL"""))
def q_accepted_session_types(spark, sf):
    """D4 as declared on the sessions source (passes: empty result)."""
    return Q.accepted_values(Inputs(spark, sf).sessions(), "session_type", SESSION_TYPES)


@query("dq_no_future", oracle("""
SELECT season, round, race_date FROM fx_races WHERE race_date > DATE '2001-06-01'"""))
def q_no_future(spark, sf):
    """D5 with an explicit ``as_of``."""
    return Q.no_future(Inputs(spark, sf).races(), "race_date", "2001-06-01").select("season", "round", "race_date")


@query("dq_row_parity", oracle("""
SELECT 'laps' AS pair, * FROM (SELECT (SELECT count(*) FROM lineitem) AS raw, (SELECT count(*) FROM fx_lap_times) AS staged) t
WHERE raw <> staged
UNION ALL
SELECT 'pit laps' AS pair, * FROM (SELECT (SELECT count(*) FROM lineitem) AS raw, (SELECT count(*) FROM fx_pit_stops) AS staged) t
WHERE raw <> staged"""))
def q_row_parity(spark, sf):
    """Raw line items vs the lap rows staged from them (all there), and vs the
    pit stops, which hold only some laps (a failing pair)."""
    raw, i = fx.table(spark, sf, "lineitem"), Inputs(spark, sf)
    pairs = [("laps", i._l("fx_lap_times")), ("pit laps", i._l("fx_pit_stops"))]
    rows = [Q.row_parity(raw, staged).select(F.lit(name).alias("pair"), "raw", "staged") for name, staged in pairs]
    return rows[0].unionByName(rows[1])


@query("dq_boundary_consistency", oracle("""
SELECT session_key, driver_number, lap_number, lap_start, lap_end FROM (
  SELECT *, lead(lap_start) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number) AS nxt
  FROM (SELECT session_key, driver_number, lap_number, lap_start,
               CASE WHEN lap_number <> 2 THEN lead(lap_start) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number) END AS lap_end
        FROM fx_lap_starts) b) c
WHERE lap_end IS DISTINCT FROM nxt"""))
def q_boundary_consistency(spark, sf):
    """Lap windows that do not end where the next lap starts; second laps have lost
    their end, so those with a lap after them fail."""
    b = M.lap_boundaries(Inputs(spark, sf).lap_starts()).select(
        "session_key", "driver_number", "lap_number", "lap_start", F.when(F.col("lap_number") != 2, F.col("lap_end")).alias("lap_end"))
    return Q.boundary_consistency(b, ["session_key", "driver_number"]).select(
        "session_key", "driver_number", "lap_number", "lap_start", "lap_end")
