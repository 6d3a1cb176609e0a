"""Results-feed landing pages -> typed raw tables.

Input: a DataFrame with one JSON page per row in column ``json`` (e.g.
``spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")``).
Every parser is ``from_json`` with an explicit schema + ``explode`` +
typed ``select``; no Python per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions.laptime import parse_lap_time
from racelake.sources import schemas as S
from racelake.sources.common import digits, num, pages, stamp, text


def _items(df: DataFrame, schema, table: str, lst: str) -> DataFrame:
    return pages(df, schema).select(F.explode(F.col(f"p.MRData.{table}.{lst}")).alias("r"))


def _races(df: DataFrame) -> DataFrame:
    return _items(df, S.RACES_PAGE, "RaceTable", "Races")


def parse_seasons(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S1."""
    r = _items(df, S.SEASONS_PAGE, "SeasonTable", "Seasons")
    return stamp(r.select(num(F.col("r.season"), "int").alias("year"), F.col("r.url").alias("url"), F.to_json("r").alias("j")),
                 ingested_at, F.col("j")).drop("j")


def parse_circuits(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Nested Location; altitude/length/turns optional (empty -> NULL)."""
    r = _items(df, S.CIRCUITS_PAGE, "CircuitTable", "Circuits")
    out = r.select(
        F.col("r.circuitId").alias("circuit_id"), F.col("r.url").alias("url"),
        F.col("r.circuitName").alias("circuit_name"), F.col("r.Location.locality").alias("locality"),
        F.col("r.Location.country").alias("country"),
        num(F.col("r.Location.lat"), "double").alias("lat"), num(F.col("r.Location.long"), "double").alias("lng"),
        num(F.col("r.Location.alt"), "double").alias("alt"),
        num(F.col("r.length"), "double").alias("length_km"), num(F.col("r.turns"), "int").alias("corners"),
        F.to_json("r").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_constructors(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S3."""
    r = _items(df, S.CONSTRUCTORS_PAGE, "ConstructorTable", "Constructors")
    out = r.select(F.col("r.constructorId").alias("constructor_id"), F.col("r.url").alias("url"),
                   F.col("r.name").alias("name"), F.col("r.nationality").alias("nationality"), F.to_json("r").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_drivers(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Missing texts default to '' (dob and code stay NULL); the permanent
    number only when present and non-empty."""
    r = _items(df, S.DRIVERS_PAGE, "DriverTable", "Drivers")
    out = r.select(
        F.col("r.driverId").alias("driver_id"), text(F.col("r.url")).alias("url"),
        text(F.col("r.givenName")).alias("given_name"), text(F.col("r.familyName")).alias("family_name"),
        F.col("r.dateOfBirth").alias("date_of_birth"), text(F.col("r.nationality")).alias("nationality"),
        num(F.col("r.permanentNumber"), "int").alias("permanent_number"), F.col("r.code").alias("code"),
        F.to_json("r").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_season_drivers(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Drivers listed for a season: pages of one season's list name it."""
    page = pages(df, S.DRIVERS_PAGE).select(F.col("p.MRData.DriverTable").alias("t"))
    out = page.select(num(F.col("t.season"), "int").alias("season"), F.explode("t.Drivers.driverId").alias("driver_id"))
    return stamp(out.where("season is not null"), ingested_at)


def parse_races(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Season calendar."""
    r = _races(df)
    out = r.select(num(F.col("r.season"), "int").alias("season"), num(F.col("r.round"), "int").alias("round"),
                   F.col("r.raceName").alias("race_name"), F.col("r.Circuit.circuitId").alias("circuit_id"),
                   F.col("r.date").alias("date"), F.col("r.time").alias("time"), F.col("r.url").alias("url"),
                   F.to_json(F.struct("r.season", "r.round", "r.raceName", "r.date", "r.time", "r.url")).alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def _result_cols(x: str, fastest: bool) -> list:
    pos = F.col(f"{x}.position")
    cols = [
        F.col(f"{x}.Driver.driverId").alias("driver_id"),
        F.col(f"{x}.Constructor.constructorId").alias("constructor_id"),
        num(F.col(f"{x}.grid"), "int").alias("grid"),
        digits(pos).alias("position"),
        text(F.col(f"{x}.positionText")).alias("position_text"),
        F.coalesce(digits(pos), num(F.col(f"{x}.positionOrder"), "int"), F.lit(0)).alias("position_order"),
        F.coalesce(num(F.col(f"{x}.points"), "double"), F.lit(0.0)).alias("points"),
        F.coalesce(num(F.col(f"{x}.laps"), "int"), F.lit(0)).alias("laps"),
        text(F.col(f"{x}.status")).alias("status"),
        num(F.col(f"{x}.Time.millis"), "long").alias("time_millis"),
    ]
    if fastest:
        cols += [
            num(F.col(f"{x}.FastestLap.rank"), "int").alias("fastest_lap_rank"),
            F.col(f"{x}.FastestLap.Time.time").alias("fastest_lap_time"),
            num(F.col(f"{x}.FastestLap.AverageSpeed.speed"), "double").alias("fastest_lap_speed"),
        ]
    cols.append(F.to_json(F.col(x)).alias("j"))
    return cols


def _race_keys():
    return [num(F.col("r.season"), "int").alias("season"), num(F.col("r.round"), "int").alias("round")]


def parse_results(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Two-level explode; position numeric-or-NULL; position order falls
    back to ``positionOrder`` then 0; optional time and fastest lap.  The car
    ``number`` is kept for the driver-number bridge (S24)."""
    r = _races(df).select("r", F.explode("r.Results").alias("x"))
    out = r.select(*_race_keys(), *_result_cols("x", True), num(F.col("x.number"), "int").alias("number"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_sprint(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S8."""
    r = _races(df).select("r", F.explode("r.SprintResults").alias("x"))
    out = r.select(*_race_keys(), *_result_cols("x", False))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_qualifying(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S7."""
    r = _races(df).select("r", F.explode("r.QualifyingResults").alias("x"))
    out = r.select(*_race_keys(), F.col("x.Driver.driverId").alias("driver_id"),
                   F.col("x.Constructor.constructorId").alias("constructor_id"),
                   num(F.col("x.position"), "int").alias("position"),
                   F.col("x.Q1").alias("q1"), F.col("x.Q2").alias("q2"), F.col("x.Q3").alias("q3"),
                   F.to_json("x").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_lap_times(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Races -> Laps -> Timings; lap text parsed to ms (bad text -> NULL)."""
    r = (_races(df).select("r", F.explode("r.Laps").alias("l"))
         .select("r", "l", F.explode("l.Timings").alias("t")))
    out = r.select(*_race_keys(), F.col("t.driverId").alias("driver_id"),
                   num(F.col("l.number"), "int").alias("lap"), num(F.col("t.position"), "int").alias("position"),
                   F.col("t.time").alias("time"), parse_lap_time(F.col("t.time")).alias("time_millis"),
                   F.to_json("t").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def parse_pit_stops(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Duration text -> ms, NULL when it does not parse."""
    r = _races(df).select("r", F.explode("r.PitStops").alias("x"))
    out = r.select(*_race_keys(), F.col("x.driverId").alias("driver_id"), num(F.col("x.stop"), "int").alias("stop"),
                   num(F.col("x.lap"), "int").alias("lap"), F.col("x.time").alias("time"),
                   F.col("x.duration").alias("duration"), parse_lap_time(F.col("x.duration")).alias("duration_millis"),
                   F.to_json("x").alias("j"))
    return stamp(out, ingested_at, F.col("j")).drop("j")


def _standings(df: DataFrame, lst: str) -> DataFrame:
    return (pages(df, S.STANDINGS_PAGE).select(F.explode("p.MRData.StandingsTable.StandingsLists").alias("sl"))
            .select("sl", F.explode(f"sl.{lst}").alias("x")))


def _standing_cols() -> list:
    return [F.coalesce(num(F.col("x.position"), "int"), F.lit(0)).alias("position"),
            text(F.col("x.positionText")).alias("position_text"),
            F.coalesce(num(F.col("x.points"), "double"), F.lit(0.0)).alias("points"),
            F.coalesce(num(F.col("x.wins"), "int"), F.lit(0)).alias("wins")]


def parse_driver_standings(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """constructor = first of ``Constructors[]``, else ''.  ``updated_at``
    is the version column of the replacing table."""
    r = _standings(df, "DriverStandings")
    out = r.select(num(F.col("sl.season"), "int").alias("season"), num(F.col("sl.round"), "int").alias("round"),
                   F.col("x.Driver.driverId").alias("driver_id"),
                   F.coalesce(F.try_element_at(F.col("x.Constructors"), F.lit(1)).getField("constructorId"), F.lit(""))
                   .alias("constructor_id"),
                   *_standing_cols(), F.to_json("x").alias("j"))
    out = stamp(out, ingested_at, F.col("j")).drop("j")
    return out.withColumn("updated_at", F.col("_ingested_at"))


def parse_constructor_standings(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """S12."""
    r = _standings(df, "ConstructorStandings")
    out = r.select(num(F.col("sl.season"), "int").alias("season"), num(F.col("sl.round"), "int").alias("round"),
                   F.col("x.Constructor.constructorId").alias("constructor_id"),
                   *_standing_cols(), F.to_json("x").alias("j"))
    out = stamp(out, ingested_at, F.col("j")).drop("j")
    return out.withColumn("updated_at", F.col("_ingested_at"))
