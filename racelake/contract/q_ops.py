"""Contract queries for the generic operators (J, K, W, T, A, F, P, I families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from racelake import fixtures as fx
from racelake.contract.inputs import Inputs
from racelake.contract.q_models import FACT_QUALI_SQL, parse_ms_sql
from racelake.contract.registry import ORACLE, QUERIES, query
from racelake.contract.sqlgen import SMAP, oracle
from racelake.functions.casts import json_field, or_null, or_zero, parse_ts, with_json_fallback
from racelake.functions.laptime import format_gap, format_lap_time, parse_lap_time
from racelake.operators import dedup as K
from racelake.operators.asof import AsofRight, HotKeys, asof_join, asof_join_many
from racelake.operators.incremental import after_watermark, unseen_keys
from racelake.operators.intervals import interval_bounds, slice_intervals
from racelake.operators.lookups import lookup_update, segment_label_map
from racelake.operators.match import tolerance_match
from racelake.operators.rank import global_rank
from racelake.operators.windows import change_flag, delta_to_best, group_mean, ordinal, rows_at_group_min
from racelake.plans import models as M

KEYS = ["session_key", "driver_number"]

# ======================================================================
# as-of family over the event stream

ASOF_SINGLE_SQL = """
SELECT cd.session_key, cd.driver_number, cd.date, cd.event_id, cd.speed, loc.x, loc.y, loc.z
FROM fx_car cd ASOF LEFT JOIN fx_location loc
  ON loc.session_key = cd.session_key AND loc.driver_number = cd.driver_number AND loc.date <= cd.date"""


@query("asof_single", oracle(ASOF_SINGLE_SQL))
def q_asof_single(spark, sf):
    i = Inputs(spark, sf)
    return asof_join(i.car().select("session_key", "driver_number", "date", "event_id", "speed"),
                     i.location(), KEYS, "date", "date", ["x", "y", "z"])


ASOF_TRIPLE_SQL = """
SELECT cd.session_key, cd.driver_number, cd.date, cd.event_id, cd.speed, lb.lap_number, lb.is_pit_out_lap,
       loc.x, loc.y, f.distance_m
FROM fx_car cd
ASOF LEFT JOIN fx_lap_starts lb
  ON lb.session_key = cd.session_key AND lb.driver_number = cd.driver_number AND lb.lap_start <= cd.date
ASOF LEFT JOIN fx_location loc
  ON loc.session_key = cd.session_key AND loc.driver_number = cd.driver_number AND loc.date <= cd.date
ASOF LEFT JOIN fx_distance f
  ON f.session_key = cd.session_key AND f.driver_number = cd.driver_number AND f.date <= cd.date"""


def _triple(spark, sf, bucket=None):
    i = Inputs(spark, sf)
    return asof_join_many(
        i.car().select("session_key", "driver_number", "date", "event_id", "speed"), KEYS, "date",
        [AsofRight(i.lap_starts(), "lap_start", ["lap_number", "is_pit_out_lap"]),
         AsofRight(i.location(), "date", ["x", "y"]),
         AsofRight(i.distance(), "date", ["distance_m"])],
        bucket=bucket)


@query("asof_triple", oracle(ASOF_TRIPLE_SQL))
def q_asof_triple(spark, sf):
    """Three as-of joins in one shuffle and one sort."""
    return _triple(spark, sf)


@query("asof_bucketed", oracle(ASOF_TRIPLE_SQL))
def q_asof_bucketed(spark, sf):
    """Same result through the skew-safe path: keys of more than 18 rows are cut by time,
    with an exact carry-over of the latest row from earlier pieces."""
    return _triple(spark, sf, bucket=HotKeys(18))


@query("asof_time_buckets", oracle(ASOF_TRIPLE_SQL))
def q_asof_time_buckets(spark, sf):
    """Every key cut into 6-hour buckets, with the same carry-over."""
    return _triple(spark, sf, bucket="6 hours")


@query("asof_strict", oracle("""
SELECT cd.session_key, cd.driver_number, cd.date, cd.event_id, loc.x
FROM fx_car cd ASOF LEFT JOIN fx_location loc
  ON loc.session_key = cd.session_key AND loc.driver_number = cd.driver_number AND loc.date < cd.date"""))
def q_asof_strict(spark, sf):
    i = Inputs(spark, sf)
    return asof_join(i.car().select("session_key", "driver_number", "date", "event_id"),
                     i.location(), KEYS, "date", "date", ["x"], inclusive=False)


@query("lap_boundaries", oracle("""
SELECT session_key, driver_number, lap_number, lap_start,
       lead(lap_start) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number) AS lap_end
FROM fx_lap_starts"""))
def q_lap_boundaries(spark, sf):
    ls = Inputs(spark, sf).lap_starts().select("session_key", "driver_number", "lap_number", "lap_start")
    return interval_bounds(ls, KEYS, "lap_number", "lap_start", "lap_end")


INTERVAL_SQL = """
SELECT cd.session_key, cd.driver_number, cd.date, cd.event_id, lb.lap_number
FROM fx_car cd
ASOF LEFT JOIN (SELECT session_key, driver_number, lap_number, lap_start,
                       lead(lap_start) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number) AS lap_end
                FROM fx_lap_starts) lb
  ON lb.session_key = cd.session_key AND lb.driver_number = cd.driver_number AND lb.lap_start <= cd.date
WHERE lb.lap_number IS NOT NULL AND (lb.lap_end IS NULL OR cd.date < lb.lap_end)"""


@query("interval_slice", oracle(INTERVAL_SQL))
def q_interval_slice(spark, sf):
    i = Inputs(spark, sf)
    b = interval_bounds(i.lap_starts(), KEYS, "lap_number", "lap_start", "lap_end")
    s = slice_intervals(i.car().select("session_key", "driver_number", "date", "event_id"), b, KEYS, "date",
                        "lap_start", "lap_end", ["lap_number"])
    return s.drop("lap_end")


@query("change_flag", oracle("""
SELECT session_key, driver_number, date, event_id, x, y,
       CAST((coalesce(x, 0) <> lag(coalesce(x, 0), 1, 0) OVER w) OR (coalesce(y, 0) <> lag(coalesce(y, 0), 1, 0) OVER w) AS INTEGER) AS gps_updated
FROM (
  SELECT cd.session_key, cd.driver_number, cd.date, cd.event_id, loc.x, loc.y
  FROM fx_car cd ASOF LEFT JOIN fx_location loc
    ON loc.session_key = cd.session_key AND loc.driver_number = cd.driver_number AND loc.date <= cd.date
) t
WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY date)"""))
def q_change_flag(spark, sf):
    i = Inputs(spark, sf)
    a = asof_join(i.car().select("session_key", "driver_number", "date", "event_id"), i.location(),
                  KEYS, "date", "date", ["x", "y"])
    return change_flag(a, KEYS, "date", ["x", "y"], "gps_updated")


# ======================================================================
# event-stream functions

@query("sample_rate", oracle("""
SELECT session_key, driver_number, sample_count, duration_seconds, hz FROM (
  SELECT session_key, driver_number, count(*) AS sample_count,
         date_diff('second', min(date), max(date)) AS duration_seconds,
         CASE WHEN date_diff('second', min(date), max(date)) > 0
              THEN count(*) / date_diff('second', min(date), max(date)) ELSE 0 END AS hz
  FROM fx_car GROUP BY session_key, driver_number
  HAVING date_diff('second', min(date), max(date)) > 60) s
WHERE hz < 3.5 OR hz > 4.0"""))
def q_sample_rate(spark, sf):
    from racelake.plans.quality import sample_rate_outliers
    return sample_rate_outliers(Inputs(spark, sf).car(), KEYS, "date")


@query("ts_parse_trunc", oracle("""
SELECT event_id, date_trunc('millisecond', ts) AS ts_ms, date_trunc('second', ts) AS ts_s,
       CAST(NULL AS TIMESTAMP) AS bad
FROM events"""))
def q_ts_parse_trunc(spark, sf):
    """ISO-8601 text with 'Z' and with '+00:00' offsets parses back to the
    same instant; truncation to ms and s; junk text -> NULL."""
    ev = fx.table(spark, sf, "events").select("event_id", "ts")
    txt = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ev = ev.select("event_id",
                   F.when(F.col("event_id") % 2 == 0, F.concat(txt, F.lit("Z")))
                   .otherwise(F.concat(txt, F.lit("+00:00"))).alias("raw"))
    return ev.select("event_id", parse_ts("raw", "MILLISECOND").alias("ts_ms"),
                     parse_ts("raw", "SECOND").alias("ts_s"),
                     parse_ts(F.concat(F.lit("not a date "), F.col("raw"))).alias("bad"))


@query("date_fns", oracle("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS prev_day,
       CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(o_orderdate AS DATE) > DATE '2000-01-01' AS after_as_of
FROM orders"""))
def q_date_fns(spark, sf):
    o = fx.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", d.alias("order_day"),
                    F.date_sub(d, 1).cast("timestamp").alias("prev_day"),
                    F.year("o_orderdate").cast("int").alias("order_year"),
                    (d > F.lit("2000-01-01").cast("date")).alias("after_as_of"))


@query("time_chunks", oracle("""
WITH r AS (SELECT session_key, CAST(min(date) AS TIMESTAMP) AS s, CAST(max(date) AS TIMESTAMP) AS e
           FROM fx_samples GROUP BY session_key),
c AS (SELECT session_key, e, unnest(generate_series(s, e, INTERVAL 30 MINUTE)) AS chunk_start FROM r)
SELECT session_key, chunk_start, least(chunk_start + INTERVAL 30 MINUTE, e) AS chunk_end
FROM c WHERE chunk_start < e"""))
def q_time_chunks(spark, sf):
    from racelake.sources.chunks import time_chunks
    r = (Inputs(spark, sf)._l("fx_samples").groupBy("session_key")
         .agg(F.min("date").cast("timestamp").alias("s"), F.max("date").cast("timestamp").alias("e")))
    return time_chunks(r, ["session_key"], "s", "e", 30)


@query("json_fallback", oracle("""
SELECT event_id,
       coalesce(CASE WHEN event_type = 'view' THEN CAST(floor(value) AS INTEGER) END,
                TRY_CAST(nullif(json_extract_string(props, '$.k'), '') AS INTEGER)) AS k,
       TRY_CAST(nullif(json_extract_string(props, '$.missing'), '') AS INTEGER) AS missing
FROM events"""))
def q_json_fallback(spark, sf):
    ev = fx.table(spark, sf, "events")
    explicit = F.when(F.col("event_type") == "view", F.floor("value").cast("int"))
    return ev.select("event_id", with_json_fallback(explicit, "props", "k", "int").alias("k"),
                     json_field("props", "missing", "int").alias("missing"))


@query("incr_watermark", oracle("""
SELECT session_key, driver_number, date, event_id FROM fx_car
WHERE date > (SELECT max(date) FROM fx_car WHERE date < TIMESTAMP '2024-01-15 00:00:00')"""))
def q_incr_watermark(spark, sf):
    """The target holds samples up to mid-month; the increment is every
    sample strictly after its high watermark."""
    car = Inputs(spark, sf).car().select("session_key", "driver_number", "date", "event_id")
    target = car.filter(F.col("date") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return after_watermark(car, target, "date")


@query("eligible_sessions", oracle("""
SELECT session_key, session_type, date_end FROM fx_stg_sessions
WHERE date_end < TIMESTAMP '2000-06-01 00:00:00' AND session_type IN ('Race', 'Qualifying')"""))
def q_eligible_sessions(spark, sf):
    from racelake.plans.pipeline import eligible_sessions
    s = Inputs(spark, sf).sessions()
    return eligible_sessions(s, "2000-06-01 00:00:00").select("session_key", "session_type", "date_end")


# ======================================================================
# keyed selections

@query("latest_by_key", oracle("""
SELECT season, round, driver_id, points, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY season, round, driver_id ORDER BY updated_at DESC) AS rn
  FROM fx_driver_standings) z WHERE rn = 1"""))
def q_latest_by_key(spark, sf):
    ds = Inputs(spark, sf).driver_standings()
    return K.latest_by_key(ds, ["season", "round", "driver_id"], "updated_at").select(
        "season", "round", "driver_id", "points", "updated_at")


@query("main_session", oracle("""
SELECT session_key, meeting_key, session_type, date_start FROM (
  SELECT *, row_number() OVER (PARTITION BY meeting_key, session_type ORDER BY date_start DESC) AS rn
  FROM fx_stg_sessions) z WHERE rn = 1"""))
def q_main_session(spark, sf):
    s = K.main_per_group(Inputs(spark, sf).sessions(), ["meeting_key", "session_type"], "date_start")
    return s.filter("is_main").select("session_key", "meeting_key", "session_type", "date_start")


# Acceptable timing-feed session types per distance-feed session
# identifier, in priority order (first present wins).
IDENTIFIER_SESSION_TYPES = [
    ("FP1", ["Practice 1", "Practice"]),
    ("FP2", ["Practice 2"]),
    ("FP3", ["Practice 3"]),
    ("Q", ["Qualifying"]),
    ("SQ", ["Sprint Qualifying", "Sprint Shootout"]),
    ("S", ["Sprint"]),
    ("R", ["Race"]),
]


_OPTIONS_LIST = ", ".join("{" + f"'identifier': '{i}', 'option': '{o}', 'priority': {p}" + "}"
                          for i, opts in IDENTIFIER_SESSION_TYPES for p, o in enumerate(opts))


@query("priority_lookup", oracle(f"""
WITH rounds AS (SELECT DISTINCT season, round FROM {SMAP} x WHERE round IS NOT NULL),
idx AS (SELECT season, round, canonical_type AS option, session_key FROM {SMAP} y WHERE round IS NOT NULL),
cand AS (SELECT season, round, o.identifier, o.option, o.priority FROM (SELECT season, round, unnest([{_OPTIONS_LIST}]) AS o FROM rounds) u)
SELECT season, round, identifier, session_key FROM (
  SELECT c.season, c.round, c.identifier, i.session_key,
         row_number() OVER (PARTITION BY c.season, c.round, c.identifier
                            ORDER BY CASE WHEN i.session_key IS NULL THEN 1 ELSE 0 END, c.priority, i.session_key) AS rn
  FROM cand c LEFT JOIN idx i ON i.season = c.season AND i.round = c.round AND i.option = c.option) z
WHERE rn = 1"""))
def q_priority_lookup(spark, sf):
    """K3: session key per (round, identifier) from an ordered option list.

    Each round expands to the fixed option list (10 rows) by ``explode`` of
    a literal array, then an equi join + ``min(struct(priority, ...))``."""
    i = Inputs(spark, sf)
    sm = M.session_map(i.sessions(), i.races()).filter(F.col("round").isNotNull())
    rounds = sm.select("season", "round").distinct()
    opts = F.array(*[F.struct(F.lit(ident).alias("identifier"), F.lit(o).alias("option"), F.lit(p).alias("priority"))
                     for ident, os_ in IDENTIFIER_SESSION_TYPES for p, o in enumerate(os_)])
    cand = rounds.select("season", "round", F.explode(opts).alias("c")).select("season", "round", "c.*")
    idx = sm.select("season", "round", F.col("canonical_type").alias("option"), "session_key")
    # several sessions of one canonical type in a round: the lowest key wins
    idx = idx.groupBy("season", "round", "option").agg(F.min("session_key").alias("session_key"))
    return K.priority_lookup(cand, idx, ["season", "round", "identifier"], ["season", "round"],
                             "option", "priority", ["session_key"])


@query("round_ordinal", oracle("""
SELECT year, meeting_key, CAST(row_number() OVER (PARTITION BY year ORDER BY date_start) AS INTEGER) AS round_number
FROM (SELECT *, row_number() OVER (PARTITION BY meeting_key ORDER BY date_start DESC) AS rn
      FROM fx_stg_sessions WHERE session_type = 'Race') z WHERE rn = 1"""))
def q_round_ordinal(spark, sf):
    """Main race per meeting (latest Race), then 1..n by date per season."""
    s = Inputs(spark, sf).sessions().filter(F.col("session_type") == "Race")
    main = K.latest_by_key(s, ["meeting_key"], "date_start")
    return ordinal(main, ["year"], ["date_start"], "round_number").select("year", "meeting_key", "round_number")


@query("latest_completed_round", oracle("""
SELECT season, round, race_date FROM (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY race_date DESC, round DESC) AS rn
  FROM fx_races WHERE race_date < DATE '2001-06-01') z WHERE rn = 1"""))
def q_latest_completed_round(spark, sf):
    """T4: per season the last race run before ``as_of`` (max_by over a struct,
    partially aggregated map-side)."""
    r = Inputs(spark, sf).races().filter(F.col("race_date") < F.lit("2001-06-01").cast("date"))
    g = r.groupBy("season").agg(F.max(F.struct("race_date", "round")).alias("m"))
    return g.select("season", F.col("m.round").alias("round"), F.col("m.race_date").alias("race_date"))


@query("best_row", oracle("""
SELECT session_key, driver_number, lap_number, lap_duration FROM (
  SELECT *, row_number() OVER (PARTITION BY session_key, driver_number ORDER BY lap_duration, lap_number) AS rn
  FROM fx_stg_laps WHERE is_pit_out_lap = 0 AND lap_duration IS NOT NULL) z WHERE rn = 1"""))
def q_best_row(spark, sf):
    laps = Inputs(spark, sf).of1_laps().filter(F.col("is_pit_out_lap") == 0)
    return K.best_row(laps, KEYS, "lap_duration", ["lap_number"]).select(*KEYS, "lap_number", "lap_duration")


@query("best_lap_ms", oracle("""
SELECT session_key, driver_number, CAST(round(min(lap_duration) * 1000) AS BIGINT) AS best_ms
FROM fx_stg_laps WHERE is_pit_out_lap = 0 AND lap_duration IS NOT NULL GROUP BY session_key, driver_number"""))
def q_best_lap_ms(spark, sf):
    laps = Inputs(spark, sf).of1_laps()
    return (laps.filter((F.col("is_pit_out_lap") == 0) & F.col("lap_duration").isNotNull())
            .groupBy(*KEYS).agg(F.round(F.min("lap_duration") * 1000).cast("long").alias("best_ms")))


@query("argmax_latest", oracle("""
SELECT o_custkey, o_orderpriority AS latest_priority, o_orderdate AS latest_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) z WHERE rn = 1"""))
def q_argmax_latest(spark, sf):
    """A3: value at the latest version per key (max_by with a total-order key)."""
    o = fx.table(spark, sf, "orders")
    g = o.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderpriority", "o_orderdate"), F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return g.select("o_custkey", F.col("m.o_orderpriority").alias("latest_priority"),
                    F.col("m.o_orderdate").alias("latest_date"))


@query("dedup_any", oracle("""
SELECT session_key, driver_number, name_acronym, team_name, team_colour FROM (
  SELECT *, row_number() OVER (PARTITION BY session_key, driver_number
                               ORDER BY _ingested_at DESC, name_acronym DESC, team_name DESC, team_colour DESC) AS rn
  FROM fx_timing_drivers) z WHERE rn = 1"""))
def q_dedup_any(spark, sf):
    """A4: ``any()`` made deterministic: the latest ingested copy wins."""
    od = Inputs(spark, sf).of1_drivers()
    return K.deterministic_any(od, KEYS, ["name_acronym", "team_name", "team_colour"], "_ingested_at")


@query("group_best_row", oracle("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem l
WHERE l_extendedprice = (SELECT min(l_extendedprice) FROM lineitem l2 WHERE l2.l_orderkey = l.l_orderkey)"""))
def q_group_best_row(spark, sf):
    """Correlated ``x = (SELECT min ...)`` decorrelated as a per-key
    ``min`` aggregate + semi join (ties all kept like the SQL form)."""
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows_at_group_min(li, ["l_orderkey"], "l_extendedprice")


@query("latest_round", oracle("""
SELECT season, round, driver_id, position_order FROM fx_results
WHERE season = (SELECT max(season) FROM fx_results) AND round = (SELECT max(round) FROM fx_results
                WHERE season = (SELECT max(season) FROM fx_results))"""))
def q_latest_round(spark, sf):
    """Uncorrelated scalar subqueries -> semi join to a one-row aggregate."""
    r = Inputs(spark, sf).results()
    last_season = r.agg(F.max("season").alias("season"))
    rs = r.join(last_season, "season", "left_semi")
    last = rs.groupBy("season").agg(F.max("round").alias("round"))
    return rs.join(last, ["season", "round"], "left_semi").select("season", "round", "driver_id", "position_order")


# ======================================================================
# joins (J1-J3, J6, J7, J9, J10) and aggregations

@query("join_inner", oracle("""
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""))
def q_join_inner(spark, sf):
    c, n, r = (fx.table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (c.join(n, n["n_nationkey"] == c["c_nationkey"]).join(r, r["r_regionkey"] == n["n_regionkey"])
            .select("c_custkey", "c_name", "n_name", "r_name"))


@query("join_left_spine", oracle("""
SELECT n.n_nationkey, n.n_name, s.s_suppkey
FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey"""))
def q_join_left_spine(spark, sf):
    n, s = fx.table(spark, sf, "nation"), fx.table(spark, sf, "supplier")
    return n.join(s.withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey", "left").select(
        "n_nationkey", "n_name", "s_suppkey")


@query("join_left_const", oracle("""
SELECT n.n_nationkey, n.n_name, c.c_custkey
FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey AND c.c_mktsegment = 'BUILDING'"""))
def q_join_left_const(spark, sf):
    """The constant predicate stays on the right side (filtered before
    the join), so nations without BUILDING customers keep one NULL row."""
    n, c = fx.table(spark, sf, "nation"), fx.table(spark, sf, "customer")
    cb = c.filter(F.col("c_mktsegment") == "BUILDING")
    return n.join(cb, cb["c_nationkey"] == n["n_nationkey"], "left").select("n_nationkey", "n_name", "c_custkey")


@query("date_bridge", oracle("""
SELECT rs.meeting_key, rs.year, min(jr.round) AS round
FROM (SELECT meeting_key, year, CAST(date_start AS DATE) AS race_date_utc FROM fx_stg_sessions WHERE session_type = 'Race') rs
JOIN fx_races jr ON jr.season = rs.year
 AND (jr.race_date = rs.race_date_utc OR jr.race_date = CAST(rs.race_date_utc - INTERVAL 1 DAY AS DATE))
GROUP BY rs.meeting_key, rs.year"""))
def q_date_bridge(spark, sf):
    i = Inputs(spark, sf)
    return M._meeting_rounds(i.sessions(), i.races())


@query("tolerance_match", oracle(f"""
WITH q AS (SELECT season, round, driver_no + 1 AS driver_number, {parse_ms_sql('coalesce(q3, q2, q1)')} AS target
           FROM fx_qualifying),
al AS (SELECT session_key, driver_number, lap_number, lap_duration, CAST(round(lap_duration * 1000) AS BIGINT) AS lap_ms
       FROM fx_stg_laps WHERE is_pit_out_lap = 0 AND lap_duration IS NOT NULL AND session_key % 10 = 1),
c AS (SELECT al.session_key, al.driver_number, al.lap_number, al.lap_duration, abs(al.lap_ms - q.target) AS d
      FROM al JOIN q ON CAST(floor(al.session_key / 10) AS BIGINT) = q.season * 100 + q.round
                    AND al.driver_number = q.driver_number
      WHERE q.target IS NOT NULL AND abs(al.lap_ms - q.target) <= 50)
SELECT session_key, driver_number, lap_number, lap_duration FROM (
  SELECT *, row_number() OVER (PARTITION BY session_key, driver_number ORDER BY d, lap_number) AS rn FROM c) z
WHERE rn = 1"""))
def q_tolerance_match(spark, sf):
    """Closest qualifying lap within +-50 ms of the official time."""
    i = Inputs(spark, sf)
    q = i._l("fx_qualifying").select(
        (F.col("season") * 100 + F.col("round")).cast("long").alias("meeting"),
        (F.col("driver_no") + 1).alias("t_driver_number"),
        parse_lap_time(F.coalesce("q3", "q2", "q1")).alias("target"))
    laps = (i.of1_laps().filter((F.col("is_pit_out_lap") == 0) & F.col("lap_duration").isNotNull()
                                & (F.col("session_key") % 10 == 1))
            .select("session_key", "driver_number", "lap_number", "lap_duration",
                    M.lap_ms("lap_duration").alias("lap_ms"),
                    F.floor(F.col("session_key") / 10).cast("long").alias("meeting")))
    return tolerance_match(q, laps, [("meeting", "meeting"), ("t_driver_number", "driver_number")],
                           "target", "lap_ms", 50, ["session_key", "driver_number"],
                           ["lap_number", "lap_duration"], "lap_number")


@query("incr_unseen_key", oracle("""
SELECT season, round, driver_id, points FROM fx_results r
WHERE NOT EXISTS (SELECT 1 FROM fx_results t WHERE t.season <= 1998 AND t.season = r.season AND t.round = r.round)"""))
def q_incr_unseen_key(spark, sf):
    """Rows of rounds not yet in the target (equi left-anti join)."""
    r = Inputs(spark, sf).results()
    target = r.filter(F.col("season") <= 1998)
    return unseen_keys(r, target, ["season", "round"]).select("season", "round", "driver_id", "points")


@query("agg_basic", oracle("""
SELECT l_returnflag, l_linestatus, min(l_quantity) AS min_qty, max(l_extendedprice) AS max_price,
       round(avg(l_discount), 4) AS avg_disc, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus"""))
def q_agg_basic(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_quantity").alias("min_qty"), F.max("l_extendedprice").alias("max_price"),
        F.round(F.avg("l_discount"), 4).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("agg_count_if", oracle("""
SELECT CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS size_class,
       count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_discount >= 0.05) AS discounted
FROM lineitem GROUP BY size_class"""))
def q_agg_count_if(spark, sf):
    """A2 + A8: conditional counts, grouped by a select alias."""
    li = fx.table(spark, sf, "lineitem").withColumn(
        "size_class", F.when(F.col("l_quantity") > 25, "big").otherwise("small"))
    return li.groupBy("size_class").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"),
                                        F.count_if(F.col("l_discount") >= 0.05).alias("discounted"))


@query("delta_to_best", oracle("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       min(l_extendedprice) OVER (PARTITION BY l_orderkey) AS best_price,
       l_extendedprice - min(l_extendedprice) OVER (PARTITION BY l_orderkey) AS delta,
       round(avg(l_quantity) OVER (PARTITION BY l_orderkey, l_suppkey), 4) AS supp_avg_qty
FROM lineitem"""))
def q_delta_to_best(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                "l_extendedprice", "l_quantity")
    li = delta_to_best(li, ["l_orderkey"], "l_extendedprice", "best_price", "delta")
    li = group_mean(li, ["l_orderkey", "l_suppkey"], "l_quantity", "supp_avg_qty")
    return li.withColumn("supp_avg_qty", F.round("supp_avg_qty", 4)).drop("l_quantity")


# ======================================================================
# projections, filters, scalar functions

@query("stg_rename_cast", oracle("""
SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
       CAST(o_totalprice AS REAL) AS total, o_orderstatus AS status, 'tpch' AS _source FROM orders"""))
def q_stg_rename_cast(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("long").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
                    F.col("o_totalprice").cast("float").alias("total"), F.col("o_orderstatus").alias("status"),
                    F.lit("tpch").alias("_source"))


@query("filter_compound", oracle("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE (l_quantity > 45 AND l_discount IS NOT NULL) OR (l_returnflag IN ('A') AND l_tax < 0.01)"""))
def q_filter_compound(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.filter(((F.col("l_quantity") > 45) & F.col("l_discount").isNotNull())
                     | (F.col("l_returnflag").isin("A") & (F.col("l_tax") < 0.01))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("filter_like", oracle("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%'"))
def q_filter_like(spark, sf):
    return fx.table(spark, sf, "part").filter(F.col("p_name").like("%red%")).select("p_partkey", "p_name")


@query("string_fns", oracle("""
SELECT c_custkey, c_name || ' / ' || c_mktsegment AS label, substr(c_name, 1, 8) AS prefix,
       CAST(position('#' IN c_name) AS INTEGER) AS hash_pos, split_part(c_name, '#', 2) AS num_text,
       CASE WHEN c_mktsegment IS NOT NULL AND c_mktsegment <> '' THEN '#' || c_mktsegment END AS tag
FROM customer"""))
def q_string_fns(spark, sf):
    """concat, substring, position, split, hex-colour rule."""
    from racelake.functions.casts import hex_colour
    c = fx.table(spark, sf, "customer")
    return c.select("c_custkey", F.concat_ws(" / ", "c_name", "c_mktsegment").alias("label"),
                    F.substring("c_name", 1, 8).alias("prefix"), F.instr("c_name", "#").cast("int").alias("hash_pos"),
                    F.split_part("c_name", F.lit("#"), F.lit(2)).alias("num_text"),
                    hex_colour("c_mktsegment").alias("tag"))


@query("checked_casts", oracle("""
SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS num_or_null,
       TRY_CAST(c_mktsegment AS INTEGER) AS seg_or_null, coalesce(TRY_CAST(c_mktsegment AS INTEGER), 0) AS seg_or_zero,
       CAST(round(c_acctbal) AS BIGINT) AS bal_int
FROM customer"""))
def q_checked_casts(spark, sf):
    """``OrNull`` / ``OrZero`` / plain casts under ANSI mode."""
    c = fx.table(spark, sf, "customer")
    return c.select("c_custkey", or_null(F.split_part("c_name", F.lit("#"), F.lit(2)), "int").alias("num_or_null"),
                    or_null("c_mktsegment", "int").alias("seg_or_null"),
                    or_zero("c_mktsegment", "int").alias("seg_or_zero"),
                    F.round("c_acctbal").cast("long").alias("bal_int"))


LAP_TEXT_SQL = """(
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
       CASE l_linenumber
         WHEN 1 THEN CAST(CAST(floor(l_extendedprice / 60000) AS BIGINT) % 3 AS STRING) || ':' ||
                     lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 60 AS STRING), 2, '0') || '.' ||
                     lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')
         WHEN 2 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) % 90 AS STRING) || '.' || CAST(l_suppkey % 10 AS STRING)
         WHEN 3 THEN '1:0' || CAST(l_suppkey % 10 AS STRING) || ':03.456'
         WHEN 4 THEN ''
         WHEN 5 THEN '17:0' || CAST(l_partkey % 10 AS STRING) || '.45'
         ELSE 'DNF' END AS t
FROM lineitem)"""


@query("parse_lap_time", oracle(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, t, {parse_ms_sql('t')} AS ms
FROM {LAP_TEXT_SQL} x"""))
def q_parse_lap_time(spark, sf):
    """F1 over text in every accepted and rejected shape (M:SS.mmm, SS.m,
    H:MM:SS.mmm, empty, words)."""
    li = fx.table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    price = F.floor("l_extendedprice").cast("long")
    t = (F.when(n == 1, F.concat((F.floor(F.col("l_extendedprice") / 60000).cast("long") % 3).cast("string"), F.lit(":"),
                                 F.lpad((price % 60).cast("string"), 2, "0"), F.lit("."),
                                 F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")))
         .when(n == 2, F.concat((price % 90).cast("string"), F.lit("."), (F.col("l_suppkey") % 10).cast("string")))
         .when(n == 3, F.concat(F.lit("1:0"), (F.col("l_suppkey") % 10).cast("string"), F.lit(":03.456")))
         .when(n == 4, F.lit(""))
         .when(n == 5, F.concat(F.lit("17:0"), (F.col("l_partkey") % 10).cast("string"), F.lit(".45")))
         .otherwise(F.lit("DNF")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
                     t.alias("t"), parse_lap_time(t).alias("ms"))


@query("format_lap_time", oracle("""
SELECT season, round, driver_id, lap_number,
       CAST(CAST(floor(lap_time_ms / 60000) AS BIGINT) AS VARCHAR) || ':' ||
       lpad(CAST(CAST(floor(lap_time_ms % 60000 / 1000) AS BIGINT) AS VARCHAR), 2, '0') || '.' ||
       lpad(CAST(lap_time_ms % 1000 AS VARCHAR), 3, '0') AS lap_text,
       CASE WHEN g < 0 THEN '-' ELSE '+' END || CAST(CAST(floor(abs(g) / 1000) AS BIGINT) AS VARCHAR) || '.' ||
       lpad(CAST(abs(g) % 1000 AS VARCHAR), 3, '0') || 's' AS gap_text
FROM (SELECT *, lap_time_ms - min(lap_time_ms) OVER (PARTITION BY season, round, driver_id) AS g FROM fx_lap_times) z"""))
def q_format_lap_time(spark, sf):
    lt = Inputs(spark, sf)._l("fx_lap_times")
    lt = delta_to_best(lt, ["season", "round", "driver_id"], "lap_time_ms", "__best", "__gap")
    return lt.select("season", "round", "driver_id", "lap_number", format_lap_time("lap_time_ms").alias("lap_text"),
                     format_gap("__gap").alias("gap_text"))


@query("coalesce_best", oracle("""
SELECT season, round, driver_id, coalesce(q3, q2, q1) AS best_time FROM fx_qualifying"""))
def q_coalesce_best(spark, sf):
    q = Inputs(spark, sf).quali()
    return q.select("season", "round", "driver_id", F.coalesce("q3", "q2", "q1").alias("best_time"))


@query("math_fns", oracle("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
       abs(l_quantity - 25) AS dist, round(l_extendedprice / 1000) AS price_k, l_extendedprice / l_quantity AS unit
FROM lineitem"""))
def q_math_fns(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
                     F.abs(F.col("l_quantity") - 25).alias("dist"), F.round(F.col("l_extendedprice") / 1000).alias("price_k"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))


@query("segment_decode", oracle("""
WITH codes AS (
  SELECT CASE x % 4 WHEN 0 THEN 2048 WHEN 1 THEN 2049 WHEN 2 THEN 2051 ELSE 2064 END AS code
  FROM (SELECT unnest([lap_number, lap_number + 1, lap_number + 2, lap_number + 1, lap_number + 3, lap_number + 2]) AS x
        FROM fx_stg_laps) l)
SELECT CASE code WHEN 2048 THEN 'yellow' WHEN 2049 THEN 'green' WHEN 2051 THEN 'purple' WHEN 2064 THEN 'pit'
                 WHEN 0 THEN 'none' END AS label, count(*) AS n
FROM codes GROUP BY 1"""))
def q_segment_decode(spark, sf):
    """mini-sector codes -> colour labels (literal map, ``transform``),
    then per-label counts."""
    laps = Inputs(spark, sf).of1_laps(segments=True)
    m = segment_label_map()
    allcodes = F.concat("segments_sector_1", "segments_sector_2", "segments_sector_3")
    labels = laps.select(F.transform(allcodes, lambda c: F.element_at(m, c)).alias("labels"))
    return labels.select(F.explode("labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("sector_delta", oracle("""
WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_key, driver_number ORDER BY lap_duration, lap_number) AS rn
                          FROM fx_stg_laps WHERE is_pit_out_lap = 0 AND lap_duration IS NOT NULL AND driver_number IN (4, 9)) z
           WHERE rn = 1)
SELECT a.session_key, a.duration_sector_1 - c.duration_sector_1 AS d_s1, a.duration_sector_2 - c.duration_sector_2 AS d_s2,
       a.duration_sector_3 - c.duration_sector_3 AS d_s3, a.lap_duration - c.lap_duration AS d_lap
FROM b a JOIN b c ON c.session_key = a.session_key AND a.driver_number = 4 AND c.driver_number = 9"""))
def q_sector_delta(spark, sf):
    """F16: per-sector delta between two drivers' best laps (self join)."""
    laps = Inputs(spark, sf).of1_laps().filter((F.col("is_pit_out_lap") == 0) & F.col("driver_number").isin(4, 9))
    b = K.best_row(laps, KEYS, "lap_duration", ["lap_number"])
    a = b.filter(F.col("driver_number") == 4).alias("a")
    c = b.filter(F.col("driver_number") == 9).alias("c")
    j = a.join(c, F.col("a.session_key") == F.col("c.session_key"))
    d = lambda x: (F.col(f"a.{x}") - F.col(f"c.{x}"))
    return j.select(F.col("a.session_key").alias("session_key"), d("duration_sector_1").alias("d_s1"),
                    d("duration_sector_2").alias("d_s2"), d("duration_sector_3").alias("d_s3"),
                    d("lap_duration").alias("d_lap"))


@query("global_lap_rank", oracle("""
SELECT lap_duration, session_key, driver_number, lap_number,
       row_number() OVER (ORDER BY lap_duration ASC NULLS LAST, session_key ASC NULLS FIRST, driver_number ASC NULLS FIRST,
                          lap_number ASC NULLS FIRST) AS lap_rank
FROM fx_stg_laps"""))
def q_global_lap_rank(spark, sf):
    """Every lap in order of its time; the rank column shows the order itself."""
    laps = Inputs(spark, sf).of1_laps().select("lap_duration", "session_key", "driver_number", "lap_number")
    order = [F.asc_nulls_last("lap_duration"), F.asc("session_key"), F.asc("driver_number"), F.asc("lap_number")]
    return global_rank(laps, order, "lap_rank")


# ======================================================================
# operators that models and reports are made of, each on its own

@query("topk_semi_orders", oracle("""
WITH top AS (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM top)"""))
def q_topk_semi(spark, sf):
    """Rows of the 25 largest of another table (top-k, then a semi join)."""
    top = fx.table(spark, sf, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(25).select(F.col("c_custkey").alias("o_custkey"))
    return fx.table(spark, sf, "orders").join(top, "o_custkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice")


@query("distinct_flag", oracle("SELECT l_orderkey, l_suppkey, 1 AS has_return FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL"))
def q_distinct_flag(spark, sf):
    """A5: distinct keys with a constant flag."""
    li = fx.table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return li.select("l_orderkey", "l_suppkey").distinct().withColumn("has_return", F.lit(1))


@query("distinct_seasons", oracle("SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n FROM orders GROUP BY 1"))
def q_distinct_seasons(spark, sf):
    """The seasons that occur, with their size."""
    o = fx.table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query("head_to_head", oracle("""
SELECT a.season, a.driver_id AS driver, b.driver_id AS other, count(*) FILTER (WHERE a.finish_position < b.finish_position) AS wins, count(*) AS races
FROM fx_results_full a JOIN fx_results_full b ON a.season = b.season AND a.round = b.round AND a.driver_id <> b.driver_id
WHERE a.driver_id IN ('d01', 'd05', 'd09') AND b.driver_id IN ('d01', 'd05', 'd09')
  AND a.finish_position IS NOT NULL AND b.finish_position IS NOT NULL
GROUP BY a.season, a.driver_id, b.driver_id"""))
def q_head_to_head(spark, sf):
    """Races of one driver against another, in every season (self join on the race)."""
    r = Inputs(spark, sf).results().filter(F.col("driver_id").isin("d01", "d05", "d09") & F.col("finish_position").isNotNull())
    a = r.select("season", "round", F.col("driver_id").alias("driver"), F.col("finish_position").alias("own"))
    b = r.select("season", "round", F.col("driver_id").alias("other"), F.col("finish_position").alias("theirs"))
    return (a.join(b, ["season", "round"]).filter("driver <> other").groupBy("season", "driver", "other")
            .agg(F.count_if(F.col("own") < F.col("theirs")).alias("wins"), F.count(F.lit(1)).alias("races")))


@query("match_status_counts", oracle(f"""
SELECT season, best_source_match, count(*) AS n FROM {FACT_QUALI_SQL} f GROUP BY season, best_source_match"""))
def q_match_status(spark, sf):
    """how the official best times were matched, by season."""
    i = Inputs(spark, sf)
    fq = M.fact_qualifying(i.quali(), i.driver_map(), M.session_map(i.sessions(), i.races()), i.of1_laps())
    return fq.groupBy("season", "best_source_match").agg(F.count(F.lit(1)).alias("n"))


@query("positions_gained_all", oracle("""
SELECT season, round, driver_id, CAST(grid_position AS INTEGER) - CAST(finish_position AS INTEGER) AS gained FROM fx_results_full"""))
def q_positions_gained(spark, sf):
    """signed difference of two unsigned places; NULL where the driver did not finish."""
    r = Inputs(spark, sf).results()
    return r.select("season", "round", "driver_id", (F.col("grid_position").cast("int") - F.col("finish_position").cast("int")).alias("gained"))


@query("join_inner_dims", oracle("""
SELECT l_orderkey, l_linenumber, c_custkey, n_name, r_name FROM lineitem
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""))
def q_join_inner_dims(spark, sf):
    """A fact with its chain of dimensions, by inner equi joins."""
    t = lambda name, *cols: fx.table(spark, sf, name).select(*cols)
    dims = (t("customer", "c_custkey", "c_nationkey").join(t("nation", "n_nationkey", "n_name", "n_regionkey"), F.expr("n_nationkey = c_nationkey"))
            .join(t("region", "r_regionkey", "r_name"), F.expr("r_regionkey = n_regionkey")))
    return (t("lineitem", "l_orderkey", "l_linenumber").join(t("orders", "o_orderkey", "o_custkey"), F.expr("o_orderkey = l_orderkey"))
            .join(dims, F.expr("c_custkey = o_custkey")).select("l_orderkey", "l_linenumber", "c_custkey", "n_name", "r_name"))


@query("lookup_update_suppliers", oracle("""
SELECT s_suppkey, s_nationkey, CASE s_nationkey WHEN 1 THEN 'north' WHEN 5 THEN 'south' ELSE s_name END AS s_name FROM supplier"""))
def q_lookup_update(spark, sf):
    """Values of the listed keys replaced from a constant table, all others kept."""
    lookup = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("s_nationkey"), F.lit(v).alias("s_name")) for k, v in ((1, "north"), (5, "south"))])))
    return lookup_update(fx.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name"), lookup, "s_nationkey", ["s_name"])


# ======================================================================
# operators whose whole job is that of the model or report made of them

def _whole(name: str, target: str) -> None:
    QUERIES[name], ORACLE[name] = QUERIES[target], ORACLE[target]


_whole("topk_semi", "rep_points_progression")
_whole("match_status", "mart_fact_qualifying")
_whole("positions_gained", "rep_positions_gained")
_whole("lookup_update", "mart_dim_circuits")
