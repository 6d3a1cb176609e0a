"""Domain-shaped adapters over the driver's TPC-H-style tables.

The models and reports need motorsport-shaped inputs (races, results, laps,
sessions, samples...).  Each adapter below is one SQL body that runs unchanged
in Spark SQL and in DuckDB, so the Spark job and the SQL oracle start from the
same rows.  Spark gets the base tables as CTEs over ``parquet.`path``` (no
session-global views), DuckDB gets them as its pre-registered views.

Adapters only shape input; every operator, model and report applied on top is
a library function.

All rows of the base tables are used, and keys grow with them: every further
1,500 customers bring 20 more drivers and seven more seasons of their own,
so races and laps per race keep their size while their number follows the data.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from racelake.plans.pipeline import read_if_written

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]

# customers come in blocks of 1,500; each block races in its own seven seasons
_BLOCK = "CAST(floor(o_custkey / 1500) AS BIGINT)"
_SEASON = f"CAST(year(o_orderdate) + 7 * {_BLOCK} AS INT)"
_DRIVER_NO = f"CAST(o_custkey % 20 + 20 * {_BLOCK} AS INT)"


def _two(n: str) -> str:
    """A number as text, with at least two digits."""
    return f"CASE WHEN {n} < 10 THEN '0' ELSE '' END || CAST({n} AS STRING)"


# name -> (dependencies, SQL body).  Order matters only through dependencies.
ADAPTERS: dict[str, tuple[list[str], str]] = {}


def _add(name: str, deps: list[str], sql: str) -> None:
    ADAPTERS[name] = (deps, sql.strip())


_add("fx_races", ["orders"], f"""
SELECT season, round, 'GP ' || CAST(round AS STRING) AS race_name, 'k' || CAST(round AS STRING) AS circuit_id,
       make_date(season, round, 15) AS race_date
FROM (SELECT DISTINCT {_SEASON} AS season, CAST(month(o_orderdate) AS INT) AS round FROM orders) o
""")

_add("fx_drivers", ["orders"], f"""
SELECT 'd' || {_two("n")} AS driver_id, 'Given' || CAST(n AS STRING) AS given_name, 'Family' || CAST(n AS STRING) AS family_name
FROM (SELECT DISTINCT {_DRIVER_NO} AS n FROM orders) o
""")

_add("fx_constructors", ["supplier"], """
SELECT 'c' || CAST(s_suppkey AS STRING) AS constructor_id, s_name AS constructor_name
FROM supplier
""")

_add("fx_results", ["orders"], f"""
SELECT season, round, driver_id, constructor_id, driver_no, grid_position, position_order,
       CASE WHEN (driver_no + round) % 9 = 0 THEN NULL ELSE position_order END AS finish_position,
       CAST(CASE position_order WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 ELSE 0 END AS DOUBLE) AS points,
       CASE WHEN (driver_no + round) % 9 = 0 THEN 'Retired' ELSE 'Finished' END AS status,
       CAST(8 AS INT) AS laps_completed
FROM (
  SELECT season, round, driver_no,
         'd' || {_two("driver_no")} AS driver_id,
         'c' || CAST(CAST(floor(driver_no / 2) AS BIGINT) AS STRING) AS constructor_id,
         CAST(row_number() OVER (PARTITION BY season, round ORDER BY k_max DESC) AS INT) AS position_order,
         CAST(row_number() OVER (PARTITION BY season, round ORDER BY k_min) AS INT) AS grid_position
  FROM (
    SELECT {_SEASON} AS season, CAST(month(o_orderdate) AS INT) AS round,
           {_DRIVER_NO} AS driver_no, max(o_orderkey) AS k_max, min(o_orderkey) AS k_min
    FROM orders GROUP BY 1, 2, 3
  ) g
) r
""")

_add("fx_lap_times", ["lineitem", "orders"], f"""
SELECT season, round, 'd' || {_two("driver_no")} AS driver_id, driver_no,
       CAST(row_number() OVER (PARTITION BY season, round, driver_no
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INT) AS lap_number,
       lap_time_ms, jit
FROM (
  SELECT {_SEASON} AS season, CAST(month(o_orderdate) AS INT) AS round, {_DRIVER_NO} AS driver_no,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
         60000 + CAST(floor(l_extendedprice) AS BIGINT) % 40000 AS lap_time_ms,
         (l_partkey * 37 + l_suppkey * 11) % 801 - 400 AS jit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
) x
""")

_add("fx_qualifying", ["fx_results", "fx_lap_times"], """
SELECT season, round, driver_id, constructor_id, driver_no, grid_position AS qualifying_position, best_ms,
       t AS q1, CASE WHEN grid_position <= 15 THEN t END AS q2, CASE WHEN grid_position <= 10 THEN t END AS q3
FROM (
  SELECT r.season, r.round, r.driver_id, r.constructor_id, r.driver_no, r.grid_position, l.lap_time_ms AS best_ms,
         CAST(CAST(floor(l.lap_time_ms / 60000) AS BIGINT) AS STRING) || ':' ||
         lpad(CAST(CAST(floor(l.lap_time_ms % 60000 / 1000) AS BIGINT) AS STRING), 2, '0') || '.' ||
         lpad(CAST(l.lap_time_ms % 1000 AS STRING), 3, '0') AS t
  FROM fx_results r LEFT JOIN fx_lap_times l
    ON l.season = r.season AND l.round = r.round AND l.driver_no = r.driver_no AND l.lap_number = 1
) z
""")

_add("fx_sessions", ["fx_races"], """
SELECT CAST((season * 100 + round) * 10 + n AS BIGINT) AS session_key, CAST(season * 100 + round AS BIGINT) AS meeting_key,
       season AS year,
       CASE n WHEN 1 THEN 'Qualifying' WHEN 2 THEN 'Sprint' ELSE 'Race' END AS session_name,
       CASE n WHEN 1 THEN 'Qualifying' ELSE 'Race' END AS session_type,
       CAST(race_date AS TIMESTAMP) + INTERVAL '1' HOUR * (CASE n WHEN 1 THEN -22 WHEN 2 THEN -26 ELSE 15 END
         + CASE WHEN round = 11 AND n = 3 THEN 12 ELSE 0 END) AS date_start
FROM (SELECT season, round, race_date, 1 AS n FROM fx_races
      UNION ALL SELECT season, round, race_date, 2 AS n FROM fx_races
      UNION ALL SELECT season, round, race_date, 3 AS n FROM fx_races) s
WHERE season >= 1998 AND (n <> 2 OR round % 4 = 0)
""")

_add("fx_driver_id_map", ["fx_results"], """
SELECT DISTINCT driver_id AS jolpica_driver_id, driver_no + 1 AS openf1_driver_number, season
FROM fx_results WHERE season >= 1998 AND driver_no <> 13
""")

_add("fx_timing_laps", ["fx_lap_times", "fx_qualifying"], """
SELECT CAST((l.season * 100 + l.round) * 10 + 3 AS BIGINT) AS session_key, l.driver_no + 1 AS driver_number, l.lap_number,
       CAST(l.lap_time_ms AS DOUBLE) / CAST(1000 AS DOUBLE) AS lap_duration, CASE WHEN l.lap_number % 10 = 0 THEN 1 ELSE 0 END AS is_pit_out_lap
FROM fx_lap_times l WHERE l.season >= 1998
UNION ALL
SELECT CAST((q.season * 100 + q.round) * 10 + 1 AS BIGINT), q.driver_no + 1, l.lap_number,
       CAST(q.best_ms + l.jit AS DOUBLE) / CAST(1000 AS DOUBLE), CASE WHEN l.lap_number % 10 = 0 THEN 1 ELSE 0 END
FROM fx_qualifying q JOIN fx_lap_times l
  ON l.season = q.season AND l.round = q.round AND l.driver_no = q.driver_no
WHERE q.season >= 1998
""")

_add("fx_samples", ["events"], """
SELECT CAST(9000 + floor((day(ts) - 1) / 7) AS BIGINT) AS session_key, CAST(user_id AS INT) AS driver_number,
       ts AS date, event_type, CAST(floor(value) AS INT) AS v, event_id
FROM events
""")

# ---- additional adapters (same construction rule: deterministic SQL over the
# driver's tables that runs unchanged in both engines) ----------------------

# results with the columns the staging table carries
_add("fx_results_full", ["fx_results"], """
SELECT season, round, driver_id, constructor_id, driver_no, grid_position, finish_position,
       CASE WHEN finish_position IS NULL THEN 'R' ELSE CAST(finish_position AS STRING) END AS position_text,
       position_order, points, laps_completed, status,
       CASE WHEN finish_position IS NULL THEN NULL ELSE CAST(5400000 + position_order * 1500 AS BIGINT) END AS time_millis,
       CASE WHEN finish_position IS NULL THEN NULL ELSE grid_position END AS fastest_lap_rank,
       CASE WHEN finish_position IS NULL THEN NULL ELSE '1:3' || CAST(grid_position % 10 AS STRING) || '.500' END AS fastest_lap_time,
       CASE WHEN finish_position IS NULL THEN NULL ELSE CAST(200 + grid_position AS DOUBLE) END AS fastest_lap_speed
FROM fx_results
""")

# sprint results on rounds divisible by 4 (the fixture's sprint weekends)
_add("fx_sprint_results", ["fx_results"], """
SELECT season, round, driver_id, constructor_id, driver_no, grid_position,
       CASE WHEN (driver_no + round) % 7 = 0 THEN NULL ELSE position_order END AS finish_position,
       CASE WHEN (driver_no + round) % 7 = 0 THEN 'R' ELSE CAST(position_order AS STRING) END AS position_text,
       position_order,
       CAST(CASE position_order WHEN 1 THEN 8 WHEN 2 THEN 7 WHEN 3 THEN 6 WHEN 4 THEN 5 ELSE 0 END AS DOUBLE) AS points,
       CAST(4 AS INT) AS laps_completed,
       CASE WHEN (driver_no + round) % 7 = 0 THEN 'Retired' ELSE 'Finished' END AS status,
       CASE WHEN (driver_no + round) % 7 = 0 THEN NULL ELSE CAST(1800000 + position_order * 700 AS BIGINT) END AS time_millis
FROM (
  SELECT season, round, driver_id, constructor_id, driver_no, position_order AS grid_position,
         CAST(row_number() OVER (PARTITION BY season, round ORDER BY grid_position DESC) AS INT) AS position_order
  FROM fx_results WHERE round % 4 = 0
) s
""")

# jolpica pit stops: two stops per driver-race at laps 12 and 30
_add("fx_pit_stops", ["fx_lap_times"], """
SELECT season, round, driver_id, CASE WHEN lap_number = 12 THEN 1 ELSE 2 END AS stop_number,
       lap_number, CAST(20000 + (jit + 400) * 10 AS BIGINT) AS pit_duration_ms,
       CAST(CAST(floor((20000 + (jit + 400) * 10) / 1000) AS BIGINT) AS STRING) || '.' ||
       lpad(CAST((20000 + (jit + 400) * 10) % 1000 AS STRING), 3, '0') AS pit_duration
FROM fx_lap_times WHERE lap_number IN (12, 30)
""")

# timing-feed stints: three per driver in every race session
_add("fx_stints", ["fx_timing_laps"], """
SELECT session_key, driver_number, 1 AS stint_number, 1 AS lap_start, 12 AS lap_end, 'SOFT' AS compound, 0 AS tyre_age_at_start
FROM (SELECT DISTINCT session_key, driver_number FROM fx_timing_laps WHERE session_key % 10 = 3) d
UNION ALL
SELECT session_key, driver_number, 2, 13, 30, 'MEDIUM', 2
FROM (SELECT DISTINCT session_key, driver_number FROM fx_timing_laps WHERE session_key % 10 = 3) d
UNION ALL
SELECT session_key, driver_number, 3, 31, CAST(NULL AS INT), 'HARD', 0
FROM (SELECT DISTINCT session_key, driver_number FROM fx_timing_laps WHERE session_key % 10 = 3) d
""")

# timing-feed drivers; rounds divisible by 3 were ingested twice (second copy later)
_add("fx_timing_drivers", ["fx_timing_laps"], f"""
SELECT session_key, driver_number, name_acronym, team_name,
       CASE WHEN copy = 2 THEN team_colour || 'F' ELSE team_colour END AS team_colour,
       headshot_url,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * copy AS TIMESTAMP) AS _ingested_at
FROM (
  SELECT session_key, driver_number,
         'D' || {_two("driver_number")} AS name_acronym,
         'Team ' || CAST(CAST(floor((driver_number - 1) / 2) AS BIGINT) AS STRING) AS team_name,
         CASE WHEN driver_number % 5 = 0 THEN '' ELSE 'A0' || lpad(CAST(driver_number AS STRING), 4, '0') END AS team_colour,
         CASE WHEN driver_number % 7 = 0 THEN NULL WHEN driver_number % 7 = 1 THEN ''
              ELSE 'https://img.example/' || CAST(driver_number AS STRING) || '/' || CAST(session_key AS STRING) || '.png' END AS headshot_url
  FROM (SELECT DISTINCT session_key, driver_number FROM fx_timing_laps) t
) b0
JOIN (SELECT session_key AS sk, 1 AS copy FROM (SELECT DISTINCT session_key FROM fx_timing_laps) a
      UNION ALL
      SELECT session_key AS sk, 2 AS copy FROM (SELECT DISTINCT session_key FROM fx_timing_laps) a
      WHERE CAST(floor(session_key / 10) AS BIGINT) % 3 = 0) c ON c.sk = b0.session_key
""")

# cumulative driver standings per round; rounds divisible by 3 also carry a stale version
_add("fx_driver_standings", ["fx_results"], """
SELECT season, round, driver_id, constructor_id,
       CAST(row_number() OVER (PARTITION BY season, round, v ORDER BY cum_points DESC, driver_id) AS INT) AS standing_position,
       cum_points - CASE WHEN v = 1 THEN 1 ELSE 0 END AS points,
       CAST(cum_wins AS INT) AS wins,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * v AS TIMESTAMP) AS updated_at
FROM (
  SELECT season, round, driver_id, constructor_id,
         sum(points) OVER (PARTITION BY season, driver_id ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_points,
         sum(CASE WHEN position_order = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY season, driver_id ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_wins
  FROM fx_results
) c0
JOIN (SELECT DISTINCT season AS vs, round AS vr, 2 AS v FROM fx_results
      UNION ALL
      SELECT DISTINCT season AS vs, round AS vr, 1 AS v FROM fx_results WHERE round % 3 = 0) vv
  ON vv.vs = c0.season AND vv.vr = c0.round
""")

_add("fx_constructor_standings", ["fx_driver_standings"], """
SELECT season, round, constructor_id,
       CAST(row_number() OVER (PARTITION BY season, round, updated_at ORDER BY points DESC, constructor_id) AS INT) AS standing_position,
       points, CAST(wins AS INT) AS wins, updated_at
FROM (
  SELECT season, round, constructor_id, updated_at, sum(points) AS points, sum(wins) AS wins
  FROM fx_driver_standings GROUP BY season, round, constructor_id, updated_at
) g
""")

# circuits: even-numbered ones were landed before the length/turns columns
# existed, so only their raw JSON carries those values
_add("fx_circuits", ["fx_races"], """
SELECT circuit_id, 'Circuit ' || CAST(n AS STRING) AS circuit_name, 'Town ' || CAST(n AS STRING) AS locality,
       'Country ' || CAST(n % 5 AS STRING) AS country, CAST(n AS DOUBLE) * 1.5 AS lat, CAST(n AS DOUBLE) * -2.25 AS lng,
       CAST(n * 10 AS DOUBLE) AS alt,
       CASE WHEN n % 2 = 1 THEN CAST(3 + floor(n / 4) AS DOUBLE) + (n % 4) * 0.25 END AS length_km,
       CASE WHEN n % 2 = 1 THEN CAST(10 + n AS INT) END AS corners,
       CASE WHEN n % 2 = 0 THEN '{"circuitId": "' || circuit_id || '", "length": "' || CAST(CAST(3 + floor(n / 4) AS BIGINT) AS STRING)
                 || '.' || CAST((n % 4) * 25 AS STRING) || '", "turns": "' || CAST(10 + n AS STRING) || '"}'
            ELSE '{"circuitId": "' || circuit_id || '"}' END AS _raw_json,
       'https://circuits.example/' || circuit_id AS url
FROM (SELECT DISTINCT circuit_id, CAST(substr(circuit_id, 2) AS INT) AS n FROM fx_races) c
""")

# stats lookup for circuits divisible by 3 (shape of the fixed-constants update)
_add("fx_circuit_stats", ["fx_races"], """
SELECT DISTINCT circuit_id, CAST(round AS DOUBLE) / 2 + 3 AS length_km, CAST(round + 20 AS INT) AS corners
FROM fx_races WHERE round % 3 = 0
""")

# car samples / lap starts / GPS / distance views over the event stream
_add("fx_car", ["fx_samples"], """
SELECT session_key, driver_number, date, v AS speed, v * 100 AS rpm, v % 8 AS n_gear, v % 101 AS throttle,
       CASE WHEN v % 3 = 0 THEN 100 ELSE 0 END AS brake, v % 14 AS drs, event_id
FROM fx_samples WHERE event_type = 'view'
""")

_add("fx_lap_starts", ["fx_samples"], """
SELECT session_key, driver_number,
       CAST(row_number() OVER (PARTITION BY session_key, driver_number ORDER BY date) AS INT) AS lap_number,
       date AS lap_start, CAST(v AS DOUBLE) + 60.0 AS lap_duration,
       CASE WHEN v % 10 = 0 THEN 1 ELSE 0 END AS is_pit_out_lap
FROM fx_samples WHERE event_type = 'signup'
""")

_add("fx_location", ["fx_samples"], """
SELECT session_key, driver_number, date, v % 50 AS x, v % 7 AS y, v % 3 AS z
FROM fx_samples WHERE event_type = 'click'
""")

_add("fx_distance", ["fx_samples"], """
SELECT session_key, driver_number, date, CAST(v AS DOUBLE) AS distance_m
FROM fx_samples WHERE event_type = 'purchase'
""")

# the telemetry sessions 9000..9004 as timing-feed sessions of one meeting per
# week; races table rows so the calendar bridge finds them
_add("fx_sample_sessions", ["fx_samples"], """
SELECT session_key, CAST(session_key AS BIGINT) AS meeting_key, CAST(2024 AS INT) AS year,
       CASE WHEN session_key % 2 = 0 THEN 'Race' ELSE 'Qualifying' END AS session_name,
       CASE WHEN session_key % 2 = 0 THEN 'Race' ELSE 'Qualifying' END AS session_type,
       CAST(min(date) AS TIMESTAMP) AS date_start
FROM fx_samples GROUP BY session_key
""")


# ---- staging-shaped views: exactly the columns the models read -----------

_add("fx_stg_laps", ["fx_timing_laps", "fx_sessions"], """
SELECT l.session_key, l.driver_number, l.lap_number,
       s.date_start + INTERVAL '1' SECOND * (l.lap_number * 90) AS lap_start,
       CASE WHEN l.lap_number % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE l.lap_duration END AS lap_duration,
       l.is_pit_out_lap,
       CAST(floor(l.lap_duration * 300) AS DOUBLE) / 1000 AS duration_sector_1,
       CAST(floor(l.lap_duration * 350) AS DOUBLE) / 1000 AS duration_sector_2,
       CASE WHEN l.lap_number % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(floor(l.lap_duration * 350) AS DOUBLE) / 1000 END AS duration_sector_3,
       CAST(250 + l.lap_number % 30 AS INT) AS i1_speed,
       CAST(260 + l.lap_number % 20 AS INT) AS i2_speed,
       CAST(300 + l.driver_number AS INT) AS st_speed
FROM fx_timing_laps l JOIN fx_sessions s ON s.session_key = l.session_key
""")

_add("fx_stg_jolpica_laps", ["fx_lap_times"], """
SELECT season, round, driver_id, lap_number,
       CAST((lap_number + driver_no) % 20 + 1 AS INT) AS lap_position,
       CAST(CAST(floor(lap_time_ms / 60000) AS BIGINT) AS STRING) || ':' ||
         lpad(CAST(CAST(floor(lap_time_ms % 60000 / 1000) AS BIGINT) AS STRING), 2, '0') || '.' ||
         lpad(CAST(lap_time_ms % 1000 AS STRING), 3, '0') AS lap_time,
       CAST(lap_time_ms AS BIGINT) AS lap_time_ms
FROM fx_lap_times
""")

_add("fx_stg_sessions", ["fx_sessions"], """
SELECT session_key, session_name, session_type, year, meeting_key, date_start,
       date_start + INTERVAL '2' HOUR AS date_end,
       'Loc ' || CAST(meeting_key % 100 AS STRING) AS location,
       'Country ' || CAST(meeting_key % 5 AS STRING) AS country_name,
       'C' || CAST(meeting_key % 5 AS STRING) AS country_code,
       'Short ' || CAST(meeting_key % 100 AS STRING) AS circuit_short_name
FROM fx_sessions
""")

_add("fx_stg_drivers", ["fx_drivers"], """
SELECT driver_id, given_name, family_name, given_name || ' ' || family_name AS full_name,
       CAST(DATE '1980-01-01' + INTERVAL '1' DAY * (CAST(substr(driver_id, 2) AS INT) * 97) AS DATE) AS date_of_birth,
       'Nation ' || CAST(CAST(substr(driver_id, 2) AS INT) % 4 AS STRING) AS nationality,
       CASE WHEN CAST(substr(driver_id, 2) AS INT) % 6 = 5 THEN CAST(NULL AS INT) ELSE CAST(substr(driver_id, 2) AS INT) + 1 END AS permanent_number,
       upper(substr(family_name, 1, 3)) AS driver_code,
       'https://drivers.example/' || driver_id AS url
FROM fx_drivers
""")

_add("fx_stg_constructors", ["fx_constructors"], """
SELECT constructor_id, constructor_name, 'Nation ' || CAST(CAST(substr(constructor_id, 2) AS INT) % 3 AS STRING) AS nationality,
       'https://teams.example/' || constructor_id AS url
FROM fx_constructors
""")

_add("fx_sample_races", ["fx_sample_sessions"], """
SELECT year AS season, CAST(session_key - 8999 AS INT) AS round, 'Week ' || CAST(session_key - 8999 AS STRING) AS race_name,
       'k' || CAST(session_key - 8999 AS STRING) AS circuit_id, CAST(date_start AS DATE) AS race_date
FROM fx_sample_sessions WHERE session_type = 'Race'
""")

_add("fx_sample_drivers", ["fx_samples"], """
SELECT DISTINCT session_key, driver_number, 'S' || lpad(CAST(driver_number AS STRING), 3, '0') AS name_acronym,
       'Team ' || CAST(driver_number % 10 AS STRING) AS team_name,
       CASE WHEN driver_number % 4 = 0 THEN '' ELSE 'B' || lpad(CAST(driver_number AS STRING), 5, '0') END AS team_colour,
       CAST(TIMESTAMP '2024-02-01 00:00:00' AS TIMESTAMP) AS _ingested_at
FROM fx_samples
""")

_add("fx_sample_driver_map", ["fx_samples"], """
SELECT DISTINCT 'u' || CAST(driver_number AS STRING) AS jolpica_driver_id, driver_number AS openf1_driver_number, CAST(2024 AS INT) AS season
FROM fx_samples WHERE driver_number % 6 <> 0
""")

# Spark's own form of adapters that every lap goes through: the same rows with less to shuffle.
# A line's place among the lines of its order comes from the sort that the join needs anyway,
# so only that place, the lap time and the jitter travel on to the race.  Lines that the
# left-out columns tell apart have equal times and jitter, so the rows are the same.
SPARK_FORMS: dict[str, str] = {
    "fx_lap_times": f"""
SELECT season, round, 'd' || {_two("driver_no")} AS driver_id, driver_no,
       CAST(row_number() OVER (PARTITION BY season, round, driver_no ORDER BY l_orderkey, nth) AS INT) AS lap_number,
       lap_time_ms, jit
FROM (
  SELECT {_SEASON} AS season, CAST(month(o_orderdate) AS INT) AS round, {_DRIVER_NO} AS driver_no,
         l_orderkey, nth, 60000 + price % 40000 AS lap_time_ms, (l_partkey * 37 + l_suppkey * 11) % 801 - 400 AS jit
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey, price, CAST(row_number() OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, price) AS INT) AS nth
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice) AS BIGINT) AS price
          FROM lineitem WHERE l_orderkey IS NOT NULL) p
  ) l JOIN orders ON l_orderkey = o_orderkey
) x
""".strip(),
    # two columns of one row a session, against a row a lap
    "fx_stg_laps": ADAPTERS["fx_stg_laps"][1].replace("SELECT", "SELECT /*+ BROADCAST(s) */", 1),
}


def _order(names: list[str]) -> list[str]:
    """Adapters needed for ``names`` in dependency order."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in out:
            return
        for d in ADAPTERS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def _bases(names: list[str]) -> list[str]:
    need: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES:
            if n not in need:
                need.append(n)
            return
        for d in ADAPTERS[n][0]:
            visit(d)

    for n in names:
        visit(n)
    return need


def cte_sql(names: list[str]) -> str:
    """``WITH`` clause body (no leading WITH) defining ``names`` and their deps."""
    return ",\n".join(f"{n} AS (\n{ADAPTERS[n][1]}\n)" for n in _order(names))


def oracle_with(names: list[str], body: str) -> str:
    """DuckDB oracle text: adapters as CTEs, then the query body."""
    return f"WITH {cte_sql(names)}\n{body}"


def sql_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter as a lazy Spark plan straight over the parquet base tables."""
    bases = ",\n".join(
        f"{b} AS (SELECT * FROM parquet.`{os.path.join(sf_dir, b + '.parquet')}`)" for b in _bases([name])
    )
    return spark.sql(f"WITH {bases},\n{cte_sql([name])}\nSELECT * FROM {name}")


_READY: set[str] = set()


def _root(spark: SparkSession, sf_dir: str) -> str:
    """Per-application folder: concurrent runs sharing one checkpoint
    folder never overwrite each other's tables."""
    from racelake.session import scratch_path
    key = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    return scratch_path(spark, f"fixtures-{spark.sparkContext.applicationId}-{key}")


def _version(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Content key of a written adapter: its SQL and its dependencies' SQL,
    plus size and mtime of the base files it reads, so a table written by
    other code or from other data is never reused."""
    h = hashlib.sha1()
    for n in _order([name]):
        h.update(n.encode())
        h.update(ADAPTERS[n][1].encode())
        h.update(SPARK_FORMS.get(n, "").encode())
    for b in _bases([name]):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{b}.parquet")  # any store that Spark reads
        st = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
        h.update(f"{b}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def materialise(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write an adapter once as a Parquet table under the session's shared
    checkpoint folder (its direct inputs read from their own written
    tables) and return its path.  Later reads are plain scans with column
    pruning and filter pushdown, and lineage stops at the written table."""
    path = os.path.join(_root(spark, sf_dir), f"{name}-{_version(spark, sf_dir, name)}")
    if path in _READY:
        return path
    if read_if_written(spark, path) is not None:
        _READY.add(path)
        return path
    ctes = []
    for d in ADAPTERS[name][0]:
        src = os.path.join(sf_dir, d + ".parquet") if d in BASE_TABLES else materialise(spark, sf_dir, d)
        ctes.append(f"{d} AS (SELECT * FROM parquet.`{src}`)")
    body = SPARK_FORMS.get(name, ADAPTERS[name][1])
    spark.sql(f"WITH {', '.join(ctes)}\n{body}").write.mode("overwrite").parquet(path)
    _READY.add(path)
    return path


_FRAMES: dict[tuple[str, str], DataFrame] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Reuse one DataFrame per (session, path): the file listing and footer
    schema are resolved once, later queries start from the same relation."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _FRAMES:
        _FRAMES[key] = spark.read.parquet(path)
    return _FRAMES[key]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter as a DataFrame (materialised on first use)."""
    if name in BASE_TABLES:
        return table(spark, sf_dir, name)
    return _read(spark, materialise(spark, sf_dir, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame."""
    return _read(spark, os.path.join(sf_dir, f"{name}.parquet"))
