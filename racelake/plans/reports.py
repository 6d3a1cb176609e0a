"""Parameterised report queries over the marts (dashboard cards, app reads).

Dashboard variables become function arguments.  "Latest round" style
scalar subqueries are equi joins to a one-row-per-season aggregate (no
driver round trip); top-n lists are ``orderBy().limit()`` which plans as a
``TakeOrderedAndProject`` (each task keeps n rows) before a semi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.operators.dedup import best_row, deterministic_any, first_per_group


def _last_round(standings: DataFrame, year: int) -> DataFrame:
    s = standings.filter(F.col("season") == year)
    last = s.groupBy("season").agg(F.max("round").alias("round"))
    return s.join(last, ["season", "round"], "left_semi")


def final_standings(standings: DataFrame, year: int) -> DataFrame:
    """R1."""
    return (_last_round(standings, year)
            .select("standing_position", "driver_id", "driver_name", "constructor_id", "constructor_name",
                    "points", "wins")
            .orderBy("standing_position"))


def points_progression(standings: DataFrame, year: int, n: int = 5) -> DataFrame:
    """R2: points by round for the top ``n`` of the final standings."""
    top = _last_round(standings, year).orderBy("standing_position").limit(n).select("driver_id")
    s = standings.filter(F.col("season") == year)
    return (s.join(top, "driver_id", "left_semi")
            .select("round", "driver_name", "points", "standing_position")
            .orderBy("round", "standing_position").drop("standing_position"))


def constructor_standings(standings: DataFrame, year: int) -> DataFrame:
    """Distinct constructor rows of the last round."""
    return (_last_round(standings, year)
            .select("constructor_name", F.col("constructor_points").alias("points"),
                    F.col("constructor_position").alias("position"))
            .distinct().orderBy("position"))


def podiums(race_results: DataFrame, year: int) -> DataFrame:
    """R4."""
    return (race_results.filter(F.col("season") == year)
            .groupBy(F.col("jolpica_driver_id").alias("driver"))
            .agg(F.count_if(F.col("finish_position") == 1).alias("wins"),
                 F.count_if(F.col("finish_position") <= 3).alias("podiums"))
            .orderBy(F.desc("wins"), F.desc("podiums")))


def positions_gained(race_results: DataFrame, year: int, rnd: int) -> DataFrame:
    """Signed grid-minus-finish (F13); NULL finish stays NULL."""
    return (race_results.filter((F.col("season") == year) & (F.col("round") == rnd))
            .select(F.col("jolpica_driver_id").alias("driver"), "grid_position", "finish_position",
                    (F.col("grid_position").cast("int") - F.col("finish_position").cast("int")).alias("positions_gained"),
                    "points", "status")
            .orderBy("finish_position"))


def lap_times(lap_analysis: DataFrame, year: int, rnd: int) -> DataFrame:
    """Lap times in seconds."""
    return (lap_analysis.filter((F.col("season") == year) & (F.col("round") == rnd) & (F.col("lap_time_ms") > 0))
            .select("lap_number", "driver_id", F.round(F.col("lap_time_ms") / 1000.0, 3).alias("lap_time_seconds"))
            .orderBy("lap_number", "driver_id"))


def pit_strategy(strategy: DataFrame, year: int, rnd: int) -> DataFrame:
    """Stop durations rounded half-up to 0.01 s (computed on whole
    hundredths so the rounding is exact)."""
    return (strategy.filter((F.col("season") == year) & (F.col("round") == rnd))
            .select("driver_id", "stop_number", "pit_lap", "compound", "stint_number", "lap_start", "lap_end",
                    (F.round(F.col("pit_duration_ms") / 10.0) / 100).alias("pit_duration_seconds"))
            .orderBy("driver_id", "stop_number"))


def fastest_lap_sectors(lap_analysis: DataFrame, year: int, rnd: int) -> DataFrame:
    """Per driver the fastest lap and that lap's sectors (lowest lap
    number among equal times; replaces a correlated ``min`` + ``any``)."""
    la = lap_analysis.filter((F.col("season") == year) & (F.col("round") == rnd))
    best = first_per_group(la, ["driver_id"], ["lap_time_ms", "lap_number"])
    return (best.select("driver_id", F.col("lap_time_ms").alias("fastest_lap_ms"),
                        F.round(F.col("lap_time_ms") / 1000.0, 3).alias("fastest_lap_seconds"),
                        F.col("of1_s1").alias("s1"), F.col("of1_s2").alias("s2"), F.col("of1_s3").alias("s3"))
            .orderBy("fastest_lap_ms"))


def points_trajectory(standings: DataFrame, year: int, d1: str, d2: str) -> DataFrame:
    """R9."""
    return (standings.filter((F.col("season") == year) & F.col("driver_id").isin(d1, d2))
            .select("round", "driver_name", "points", "driver_id").orderBy("round", "driver_id").drop("driver_id"))


def avg_finish(race_results: DataFrame, year: int, d1: str, d2: str) -> DataFrame:
    """R10."""
    return (race_results.filter((F.col("season") == year) & F.col("jolpica_driver_id").isin(d1, d2)
                                & F.col("finish_position").isNotNull())
            .groupBy(F.col("jolpica_driver_id").alias("driver"))
            .agg(F.round(F.avg("finish_position"), 2).alias("avg_finish"), F.count(F.lit(1)).alias("races"))
            .orderBy("avg_finish"))


def quali_vs_race(quali: DataFrame, race_results: DataFrame, year: int, d1: str, d2: str) -> DataFrame:
    """R11."""
    q = quali.filter((F.col("season") == year) & F.col("driver_id").isin(d1, d2)).alias("q")
    r = race_results.alias("r")
    j = q.join(r, (F.col("r.season") == F.col("q.season")) & (F.col("r.round") == F.col("q.round"))
               & (F.col("r.jolpica_driver_id") == F.col("q.driver_id")))
    return (j.select(F.col("q.round").alias("round"), F.col("q.driver_id").alias("driver_id"),
                     F.col("q.qualifying_position").alias("qualifying_position"),
                     F.col("r.finish_position").alias("finish_position"),
                     (F.col("q.qualifying_position").cast("int") - F.col("r.finish_position").cast("int"))
                     .alias("positions_gained_vs_qualifying"))
            .orderBy("round", "driver_id"))


def head_to_head(race_results: DataFrame, year: int, d1: str, d2: str) -> DataFrame:
    """Races finished ahead of the other driver (J8 self join with <>)."""
    base = race_results.filter((F.col("season") == year) & F.col("jolpica_driver_id").isin(d1, d2)
                               & F.col("finish_position").isNotNull())
    r1 = base.select("season", "round", F.col("jolpica_driver_id").alias("driver"),
                     F.col("finish_position").alias("p1"))
    r2 = base.select(F.col("season").alias("s2"), F.col("round").alias("rd2"),
                     F.col("jolpica_driver_id").alias("other"), F.col("finish_position").alias("p2"))
    j = r1.join(r2, (r2["s2"] == r1["season"]) & (r2["rd2"] == r1["round"]) & (r2["other"] != r1["driver"]))
    return (j.groupBy("driver").agg(F.count_if(F.col("p1") < F.col("p2")).alias("head_to_head_wins"))
            .orderBy(F.desc("head_to_head_wins")))


def sessions(sessions_dim: DataFrame, min_season: int, session_type: str = "Qualifying") -> DataFrame:
    """Sessions of one type from ``min_season`` on."""
    return (sessions_dim.filter((F.col("session_type") == session_type) & (F.col("season") >= min_season))
            .select("session_key", "season", "round", "race_name", "circuit_name",
                    F.col("date_start").alias("qualifying_date"))
            .orderBy("season", "round"))


def quali_drivers(quali: DataFrame, drivers_dim: DataFrame, season: int, rnd: int) -> DataFrame:
    """R14."""
    fq = quali.filter((F.col("season") == season) & (F.col("round") == rnd))
    j = fq.join(drivers_dim.select("driver_id", "full_name", "driver_code", "permanent_number"), "driver_id")
    return (j.select("driver_id", "qualifying_position", "constructor_id", "full_name", "driver_code",
                     "permanent_number", F.coalesce("q3", "q2", "q1").alias("best_time"))
            .orderBy("qualifying_position"))


def quali_session_drivers(qualifying_summary: DataFrame, season: int, rnd: int) -> DataFrame:
    """R14 with team, colour, best sectors and speeds, from the summary mart."""
    return (qualifying_summary.filter((F.col("season") == season) & (F.col("round") == rnd))
            .select("qualifying_position", "driver_name", "team_name", "team_colour", "best_time",
                    "best_s1", "best_s2", "best_s3", "i1_speed", "st_speed")
            .orderBy("qualifying_position"))


def lap_trace(telemetry: DataFrame, session_key: int, driver_number: int, lap_number: int) -> DataFrame:
    """Ordered samples of one lap (partition-pruned on session_key when
    the mart is read from its partitioned layout)."""
    return (telemetry.filter((F.col("session_key") == session_key) & (F.col("driver_number") == driver_number)
                             & (F.col("lap_number") == lap_number))
            .select("date", "speed", "throttle", "brake", "n_gear", "drs", "rpm", "x", "y", "z", "distance_m")
            .orderBy("date"))


def seasons(races: DataFrame) -> DataFrame:
    """R16a / A6."""
    return races.select("season").distinct().orderBy(F.desc("season"))


def races_of(races: DataFrame, season: int) -> DataFrame:
    """R16b."""
    return (races.filter(F.col("season") == season)
            .select("round", "race_name", "circuit_id", F.col("race_date").alias("date")).orderBy("round"))


def quali_compare(quali: DataFrame, of1_laps: DataFrame, of1_drivers: DataFrame,
                  season: int, rnd: int, d1: str, d2: str) -> DataFrame:
    """Each driver's best non-pit-out lap (NULL durations never win) with
    appearance data; drivers without laps keep NULL lap columns."""
    fq = (quali.filter((F.col("season") == season) & (F.col("round") == rnd) & F.col("driver_id").isin(d1, d2))
          .select("driver_id", "qualifying_position", "q1", "q2", "q3", "session_key", "openf1_driver_number"))
    laps = best_row(of1_laps.filter(F.col("is_pit_out_lap") == 0), ["session_key", "driver_number"],
                    "lap_duration", ["lap_number"])
    lap_cols = ["lap_duration", "duration_sector_1", "duration_sector_2", "duration_sector_3",
                "i1_speed", "i2_speed", "st_speed"]
    laps = laps.select(F.col("session_key").alias("l_sk"), F.col("driver_number").alias("l_dn"), *lap_cols)
    od = deterministic_any(of1_drivers, ["session_key", "driver_number"],
                           ["team_colour", "headshot_url", "name_acronym", "team_name"],
                           "_ingested_at" if "_ingested_at" in of1_drivers.columns else None)
    od = od.select(F.col("session_key").alias("o_sk"), F.col("driver_number").alias("o_dn"),
                   "team_colour", "headshot_url", "name_acronym", "team_name")
    j = (fq.join(laps, (laps["l_sk"] == fq["session_key"]) & (laps["l_dn"] == fq["openf1_driver_number"]), "left")
         .join(od, (od["o_sk"] == fq["session_key"]) & (od["o_dn"] == fq["openf1_driver_number"]), "left"))
    return j.select("driver_id", "qualifying_position", "q1", "q2", "q3",
                    F.coalesce("q3", "q2", "q1").alias("best_time"), *lap_cols,
                    "team_colour", "headshot_url", "name_acronym", "team_name")


def lap_profile(telemetry: DataFrame, session_key: int, driver_number: int) -> DataFrame:
    """Per-lap sample count, speed range, braking samples, mean GPS position."""
    t = telemetry.filter((F.col("session_key") == session_key) & (F.col("driver_number") == driver_number))
    return (t.groupBy("lap_number")
            .agg(F.count(F.lit(1)).alias("samples"), F.min("speed").cast("int").alias("min_spd"),
                 F.max("speed").cast("int").alias("max_spd"),
                 F.count_if(F.col("brake") > 0).alias("brake_samples"),
                 F.round(F.avg("x"), 0).alias("avg_x"), F.round(F.avg("y"), 0).alias("avg_y"))
            .orderBy("lap_number"))


def distance_coverage(telemetry: DataFrame, season: int, session_type: str) -> DataFrame:
    """NULL vs filled distance samples."""
    t = telemetry.filter((F.col("season") == season) & (F.col("session_type") == session_type))
    return t.groupBy("season").agg(F.count_if(F.col("distance_m").isNull()).alias("null_count"),
                                   F.count_if(F.col("distance_m").isNotNull()).alias("populated"))
