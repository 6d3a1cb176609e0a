"""Timing-feed landing pages (flat JSON arrays) -> typed raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racelake.functions.casts import parse_ts
from racelake.sources import schemas as S
from racelake.sources.common import stamp, text, text_or


def _rows(df: DataFrame, item: T.StructType, json_col: str = "json") -> DataFrame:
    return df.select(F.explode(F.from_json(F.col(json_col), T.ArrayType(item, True))).alias("r"))


def _raw(df: DataFrame, cols: list, ingested_at: str | None) -> DataFrame:
    return stamp(df.select(*cols, F.to_json("r").alias("j")), ingested_at, F.col("j")).drop("j")


def parse_sessions(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S13."""
    r = _rows(df, S.OF1_SESSION)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.session_name").alias("session_name"),
            F.col("r.session_type").alias("session_type"), text(F.col("r.status")).alias("status"),
            text(F.col("r.gmt_offset")).alias("gmt_offset"), text(F.col("r.path")).alias("path"),
            F.col("r.date_start").alias("date_start"), F.col("r.date_end").alias("date_end"),
            F.col("r.year").alias("year"), F.col("r.circuit_key").alias("circuit_key"),
            F.col("r.circuit_short_name").alias("circuit_short_name"), F.col("r.country_key").alias("country_key"),
            F.col("r.country_code").alias("country_code"), F.col("r.country_name").alias("country_name"),
            F.col("r.location").alias("location"), F.col("r.meeting_key").alias("meeting_key")]
    return _raw(r, cols, ingested_at)


def parse_drivers(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Texts ``or ''``; headshot and country stay nullable."""
    r = _rows(df, S.OF1_DRIVER)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.driver_number").alias("driver_number")]
    cols += [text_or(F.col(f"r.{c}")).alias(c) for c in
             ("broadcast_name", "full_name", "name_acronym", "team_name", "team_colour", "first_name", "last_name")]
    cols += [F.col("r.headshot_url").alias("headshot_url"), F.col("r.country_code").alias("country_code")]
    return _raw(r, cols, ingested_at)


def parse_laps(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Rows without a start time are dropped; NULLs removed from the
    three segment arrays (missing array -> empty); pit-out flag -> 0/1."""
    r = _rows(df, S.OF1_LAP).filter(F.col("r.date_start").isNotNull() & (F.col("r.date_start") != ""))
    seg = lambda c: F.array_compact(F.coalesce(F.col(f"r.{c}"), F.array().cast("array<int>"))).alias(c)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.driver_number").alias("driver_number"),
            F.col("r.lap_number").alias("lap_number"), F.col("r.date_start").alias("date_start"),
            F.col("r.lap_duration").alias("lap_duration"),
            F.coalesce(F.col("r.is_pit_out_lap"), F.lit(False)).cast("int").alias("is_pit_out_lap"),
            *[F.col(f"r.duration_sector_{k}").alias(f"duration_sector_{k}") for k in (1, 2, 3)],
            F.col("r.i1_speed").alias("i1_speed"), F.col("r.i2_speed").alias("i2_speed"),
            F.col("r.st_speed").alias("st_speed"),
            seg("segments_sector_1"), seg("segments_sector_2"), seg("segments_sector_3")]
    return _raw(r, cols, ingested_at)


def parse_pit(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S16."""
    r = _rows(df, S.OF1_PIT)
    return _raw(r, [F.col(f"r.{c}").alias(c) for c in
                    ("session_key", "driver_number", "lap_number", "date", "pit_duration")], ingested_at)


def parse_stints(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Rows without a starting lap are dropped."""
    r = _rows(df, S.OF1_STINT).filter(F.col("r.lap_start").isNotNull())
    cols = [F.col(f"r.{c}").alias(c) for c in ("session_key", "driver_number", "stint_number", "lap_start", "lap_end")]
    cols += [text(F.col("r.compound")).alias("compound"),
             F.coalesce(F.col("r.tyre_age_at_start"), F.lit(0)).alias("tyre_age_at_start")]
    return _raw(r, cols, ingested_at)


def parse_intervals(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Gaps given as text such as ``+1 LAP`` become NULL."""
    r = _rows(df, S.OF1_INTERVAL)
    cols = [F.col(f"r.{c}").alias(c) for c in ("session_key", "driver_number", "date")]
    cols += [F.col("r.gap_to_leader").try_cast("double").alias("gap_to_leader"),
             F.col("r.interval").try_cast("double").alias("interval")]
    return _raw(r, cols, ingested_at)


def parse_weather(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Numeric defaults 0, rainfall 0/1."""
    r = _rows(df, S.OF1_WEATHER)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.date").alias("date")]
    for c in ("air_temperature", "track_temperature", "humidity", "pressure"):
        cols.append(F.coalesce(F.col(f"r.{c}"), F.lit(0.0)).alias(c))
    cols += [F.coalesce(F.col("r.wind_direction"), F.lit(0)).alias("wind_direction"),
             F.coalesce(F.col("r.wind_speed"), F.lit(0.0)).alias("wind_speed"),
             F.coalesce(F.col("r.rainfall"), F.lit(False)).cast("int").alias("rainfall")]
    return _raw(r, cols, ingested_at)


def parse_race_control(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Five nullable columns."""
    r = _rows(df, S.OF1_RACE_CONTROL)
    cols = [F.col(f"r.{c}").alias(c) for c in ("session_key", "date", "driver_number", "lap_number")]
    cols += [text(F.col("r.category")).alias("category"), F.col("r.flag").alias("flag"),
             F.col("r.scope").alias("scope"), F.col("r.sector").alias("sector"),
             text(F.col("r.message")).alias("message")]
    return _raw(r, cols, ingested_at)


def parse_car_data(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Channel defaults 0; sample time parsed to a millisecond timestamp."""
    r = _rows(df, S.OF1_CAR)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.driver_number").alias("driver_number"),
            parse_ts(F.col("r.date"), "MILLISECOND").alias("date")]
    cols += [F.coalesce(F.col(f"r.{c}"), F.lit(0)).alias(c) for c in ("rpm", "speed", "n_gear", "throttle", "brake", "drs")]
    return _raw(r, cols, ingested_at)


def parse_location(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S22."""
    r = _rows(df, S.OF1_LOCATION)
    cols = [F.col("r.session_key").alias("session_key"), F.col("r.driver_number").alias("driver_number"),
            parse_ts(F.col("r.date"), "MILLISECOND").alias("date")]
    cols += [F.coalesce(F.col(f"r.{c}"), F.lit(0)).alias(c) for c in ("x", "y", "z")]
    return _raw(r, cols, ingested_at)


TELEMETRY_PARTITIONS = ["year", "session_key"]


def write_telemetry(df: DataFrame, path: str, mode: str = "append") -> None:
    """Partition by (year, session), for raw tables by the ingest label too, and sort
    each file by (session, driver, time), so a ``session_key = ?`` read prunes to its
    folder and per-driver reads prune row groups.

    Rows are rebalanced by session: adaptive execution measures the shuffled sessions,
    merges small ones into one task and cuts a long one into tasks of the advised size.
    So a session is a few files of a good size, however hot it is, and nothing is
    computed twice for it."""
    label = [c for c in ("_batch_id",) if c in df.columns]
    out = (df.withColumn("year", F.year("date")).hint("rebalance", *TELEMETRY_PARTITIONS)
           .sortWithinPartitions("year", "session_key", *label, "driver_number", "date"))
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*TELEMETRY_PARTITIONS, *label).parquet(path))
