"""Staging views, 1:1 with raw tables: renames, casts, literal source tag.

Staging stays lazy (a function, not a table); latest-version reads (K1) are
applied here for every keyed results/timing table so re-ingested duplicates
never fan out joins downstream (N9).  The timing-feed driver table keeps its
copies (models reduce them per session with the latest ingest, N5); telemetry
is kept idempotent at ingest instead (whole-session partition replacement),
so the largest tables are never re-shuffled just to de-duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions.casts import parse_ts
from racelake.operators.dedup import latest_by_key


def _src(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("_source", F.lit(tag))


def _latest(raw: DataFrame, keys: list[str]) -> DataFrame:
    """One row per natural key, the latest ingest wins (re-ingested
    batches never fan out joins).  ``row_number() = 1`` plans with a
    map-side WindowGroupLimit."""
    if "_ingested_at" not in raw.columns:
        return raw
    return latest_by_key(raw, keys, "_ingested_at", _label(raw))


def _label(raw: DataFrame) -> list[str]:
    """The ingest label, where the table has one: later batches win over equal times."""
    return ["_batch_id"] if "_batch_id" in raw.columns else []


def stg_races(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round"]).select("season", "round", "race_name", "circuit_id", F.to_date("date").alias("race_date"),
                           F.col("time").alias("race_time_utc"), "url", "_ingested_at"), "jolpica")


def stg_results(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round", "driver_id"]).select("season", "round", "driver_id", "constructor_id", F.col("grid").alias("grid_position"),
                           F.col("position").alias("finish_position"), "position_text", "position_order", "points",
                           F.col("laps").alias("laps_completed"), "status", "time_millis", "fastest_lap_rank",
                           "fastest_lap_time", "fastest_lap_speed", "_ingested_at"), "jolpica")


def stg_sprint_results(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round", "driver_id"]).select("season", "round", "driver_id", "constructor_id", F.col("grid").alias("grid_position"),
                           F.col("position").alias("finish_position"), "position_text", "position_order", "points",
                           F.col("laps").alias("laps_completed"), "status", "time_millis", "_ingested_at"), "jolpica")


def stg_qualifying(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round", "driver_id"]).select("season", "round", "driver_id", "constructor_id",
                           F.col("position").alias("qualifying_position"), "q1", "q2", "q3", "_ingested_at"), "jolpica")


def stg_jolpica_laps(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round", "driver_id", "lap"]).select("season", "round", "driver_id", F.col("lap").alias("lap_number"),
                           F.col("position").alias("lap_position"), F.col("time").alias("lap_time"),
                           F.col("time_millis").alias("lap_time_ms"), "_ingested_at"), "jolpica")


def stg_pit_stops(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["season", "round", "driver_id", "stop"]).select("season", "round", "driver_id", F.col("stop").alias("stop_number"),
                           F.col("lap").alias("lap_number"), F.col("time").alias("pit_time_of_day"),
                           F.col("duration").alias("pit_duration"), F.col("duration_millis").alias("pit_duration_ms"),
                           "_ingested_at"), "jolpica")


def stg_drivers(raw: DataFrame) -> DataFrame:
    d = latest_by_key(raw, ["driver_id"], "_ingested_at")
    return _src(d.select("driver_id", "given_name", "family_name",
                         F.concat_ws(" ", "given_name", "family_name").alias("full_name"),
                         F.to_date("date_of_birth").alias("date_of_birth"), "nationality", "permanent_number",
                         F.col("code").alias("driver_code"), "url", "_ingested_at"), "jolpica")


def stg_constructors(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["constructor_id"]).select("constructor_id", F.col("name").alias("constructor_name"), "nationality", "url",
                           "_ingested_at"), "jolpica")


def stg_driver_standings(raw: DataFrame) -> DataFrame:
    """Latest version per (season, round, driver) — the replacing table's final state."""
    d = latest_by_key(raw, ["season", "round", "driver_id"], "updated_at")
    return _src(d.select("season", "round", "driver_id", "constructor_id", F.col("position").alias("standing_position"),
                         "position_text", "points", "wins", "updated_at", "_ingested_at"), "jolpica")


def stg_constructor_standings(raw: DataFrame) -> DataFrame:
    d = latest_by_key(raw, ["season", "round", "constructor_id"], "updated_at")
    return _src(d.select("season", "round", "constructor_id", F.col("position").alias("standing_position"),
                         "position_text", "points", "wins", "updated_at", "_ingested_at"), "jolpica")


def stg_sessions(raw: DataFrame) -> DataFrame:
    d = latest_by_key(raw, ["session_key"], "_ingested_at")
    return _src(d.select("session_key", "session_name", "session_type", "status", "gmt_offset", "year",
                         "circuit_key", "circuit_short_name", "country_code", "country_name", "location", "meeting_key",
                         parse_ts("date_start").alias("date_start"), parse_ts("date_end").alias("date_end"),
                         "_ingested_at"), "openf1")


def stg_of1_laps(raw: DataFrame) -> DataFrame:
    # whole rows are sorted once, after the shuffle; a sort before it would drop next to nothing
    d = _latest(raw.repartition("session_key", "driver_number"), ["session_key", "driver_number", "lap_number"])
    return _src(d.withColumn("lap_start", parse_ts("date_start")).drop("date_start", "_raw_json"), "openf1")


def stg_car_data(raw: DataFrame) -> DataFrame:
    return raw.select("session_key", "driver_number", F.date_trunc("MILLISECOND", "date").alias("date"),
                      "rpm", "speed", "n_gear", "throttle", "brake", "drs", "_ingested_at", *_label(raw))


def stg_location(raw: DataFrame) -> DataFrame:
    return raw.select("session_key", "driver_number", F.date_trunc("MILLISECOND", "date").alias("date"),
                      "x", "y", "z", "_ingested_at", *_label(raw))


def one_per_sample(telemetry: DataFrame) -> DataFrame:
    """One row a sample: pages of a session may land apart, or twice.  Applied to the
    sessions being rebuilt, not to the whole feed."""
    return _latest(telemetry, ["session_key", "driver_number", "date"])


def stg_stints(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["session_key", "driver_number", "stint_number"]).drop("_raw_json"), "openf1")


def stg_of1_drivers(raw: DataFrame) -> DataFrame:
    return _src(raw.drop("_raw_json"), "openf1")


def stg_distances(raw: DataFrame) -> DataFrame:
    return raw.select("session_key", "driver_number", F.date_trunc("MILLISECOND", "date").alias("date"),
                      "distance_m", "_ingested_at", *_label(raw))


def stg_seasons(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["year"]).select("year", "url", "_ingested_at"), "jolpica")


def _ts_s(c: str):
    """Second-precision timestamp from feed text (``toDateTime``)."""
    return parse_ts(c, "SECOND")


def stg_of1_pit(raw: DataFrame) -> DataFrame:
    return _src(_latest(raw, ["session_key", "driver_number", "lap_number"]).select("session_key", "driver_number", "lap_number", _ts_s("date").alias("pit_date"),
                           "pit_duration", "_ingested_at"), "openf1")


def stg_intervals(raw: DataFrame) -> DataFrame:
    raw = _latest(raw, ["session_key", "driver_number", "date"])
    return _src(raw.select("session_key", "driver_number", _ts_s("date").alias("interval_date"),
                           "gap_to_leader", "interval", "_ingested_at"), "openf1")


def stg_weather(raw: DataFrame) -> DataFrame:
    raw = _latest(raw, ["session_key", "date"])
    return _src(raw.select("session_key", _ts_s("date").alias("weather_date"), "air_temperature",
                           "track_temperature", "humidity", "pressure", "wind_direction", "wind_speed", "rainfall",
                           "_ingested_at"), "openf1")


def stg_race_control(raw: DataFrame) -> DataFrame:
    raw = _latest(raw, ["session_key", "date", "driver_number", "lap_number", "category", "flag", "scope", "sector", "message"])
    return _src(raw.select("session_key", _ts_s("date").alias("message_date"), "driver_number", "lap_number",
                           "category", "flag", "scope", "sector", "message", "_ingested_at"), "openf1")
