"""Batch pipeline: staging -> intermediate -> marts, materialised as Parquet.

The run order is plain function composition (no scheduler).  Each table is
written once and read back, which cuts lineage between layers (executor
loss re-runs one layer, not the whole chain).  Facts append only unseen
rounds (I2); telemetry tables are partitioned by (year, session_key) and
re-built per affected session with dynamic partition overwrite (I4/N15).
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.operators.asof import HotKeys, measured
from racelake.plans import models as M
from racelake.plans import staging as STG
from racelake.sources.openf1 import write_telemetry

TELEMETRY_TYPES = ("Race", "Qualifying")


def eligible_sessions(sessions: DataFrame, as_of: str, types: Sequence[str] = TELEMETRY_TYPES) -> DataFrame:
    """Sessions that have ended before ``as_of`` and whose type gets telemetry."""
    end = F.col("date_end")
    if dict(sessions.dtypes).get("date_end") == "string":
        end = F.try_to_timestamp(end)
    return sessions.filter((end < F.lit(as_of).cast("timestamp")) & F.col("session_type").isin(*types))


@dataclass
class Warehouse:
    """Table locations under one root (a shared, durable folder on a cluster)."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return os.path.join(self.root, layer, name)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame | None:
        """The table, columns added over time included; None if it was never written."""
        return read_if_written(spark, self.path(layer, name))


#: Error conditions that mean "no such table yet"; anything else is raised.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_evolving(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def _exists(spark: SparkSession, path: str) -> bool:
    return read_if_written(spark, path) is not None


def materialise(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ()) -> None:
    """Write a full-refresh table (or append)."""
    if partition_by:
        df = df.repartition(*partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_unseen(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str] = ("season", "round"),
                  repair: DataFrame | None = None) -> None:
    """Append rows whose ``keys`` are not in the table yet.  ``repair``
    (a frame of keys to reload) replaces those keys' rows: only the partitions
    (first key) that hold them are rewritten, a key that has become empty goes."""
    keys, part = list(keys), list(keys)[0]
    existing = read_if_written(spark, path)
    if repair is not None and existing is not None:
        chosen = repair.select(*keys).distinct()
        touched = chosen.select(part).distinct()
        stay = existing.join(touched, part, "left_semi").join(chosen, keys, "left_anti")
        fixed = df.join(chosen, keys, "left_semi").select(*existing.columns)
        # written aside first: the partitions read here are the ones replaced
        aside = f"{path}__repair"
        materialise(stay.unionByName(fixed), aside, partition_by=[part], sort_by=keys)
        (spark.read.schema(existing.schema).parquet(aside).repartition(part).sortWithinPartitions(*keys)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))
        existing = read_if_written(spark, path)
    new = df if existing is None else df.join(existing.select(*keys).distinct(), keys, "left_anti")
    materialise(new, path, "append", partition_by=[part], sort_by=keys)


#: A (session, driver) with more samples than this is spread over several tasks.
BUCKET = HotKeys(4_000_000)


#: Columns that differ between two loads of one and the same row.
VOLATILE = ("_ingested_at", "_batch_id", "_raw_json", "_source", "updated_at")


class Digests:
    """One digest for each key (season, round) of the sources of a fact, kept from run
    to run, so that corrected, late and withdrawn rounds are found without a list of them.

    A digest is the count, the sum and the exclusive-or of the rows' hashes: it does not
    depend on row order, and sums are combined before the shuffle."""

    def __init__(self, spark: SparkSession, wh: Warehouse, fact: str, keys: Sequence[str] = ("season", "round")):
        self.spark, self.path, self.keys = spark, wh.path("state", f"digests/{fact}"), list(keys)

    def of(self, sources: dict[str, DataFrame]) -> DataFrame:
        out = None
        for name, df in sources.items():
            row = F.xxhash64(*[F.col(c) for c in sorted(df.columns) if c not in VOLATILE])
            one = (df.select(*[F.col(k).cast("long").alias(k) for k in self.keys], row.alias("h")).groupBy(*self.keys)
                   .agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor("h")).alias("digest"))
                   .withColumn("source", F.lit(name)))
            out = one if out is None else out.unionByName(one)
        return out

    def changes(self, sources: dict[str, DataFrame]) -> DataFrame:
        """keys, source, digest where it differs from the last run's (null: rows are gone)."""
        now, log = self.of(sources), read_if_written(self.spark, self.path)
        if log is None:
            return now
        last = log.groupBy(*self.keys, "source").agg(F.max_by("digest", "run").alias("before")).filter("before is not null")
        both = now.join(last, [*self.keys, "source"], "full")
        return both.filter(~F.col("digest").eqNullSafe(F.col("before"))).drop("before")

    def commit(self, changes: DataFrame, run: int) -> None:
        changes.withColumn("run", F.lit(run).cast("long")).coalesce(1).write.mode("append").parquet(self.path)

    def run(self) -> int:
        log = read_if_written(self.spark, self.path)
        return 1 if log is None else (log.agg(F.max("run")).first()[0] or 0) + 1


def build_fact(spark: SparkSession, wh: Warehouse, fact: str, rows: DataFrame, sources: dict[str, DataFrame]) -> None:
    """Append the rounds that the fact does not hold, and replace those whose sources have
    changed since the last run; others are untouched.  The digests are committed last, so
    a run that fails in between repairs the same rounds again."""
    digests = Digests(spark, wh, fact)
    path = wh.path("state", f"digests-now/{fact}")
    digests.changes(sources).write.mode("overwrite").parquet(path)
    changes = spark.read.schema("season long, round long, digest string, source string").parquet(path)
    repair = None if changes.isEmpty() else changes.select(*digests.keys)
    append_unseen(spark, rows, wh.path("marts", fact), repair=repair)
    if repair is not None:
        digests.commit(changes, digests.run())


class Progress:
    """What a table has taken from each of its inputs: the labels of the batches (inputs
    that carry ``_batch_id``), else the newest ingest time.  A few short rows, one folder
    a commit, written only after the table itself."""

    def __init__(self, spark: SparkSession, wh: Warehouse, table: str):
        self.spark, self.path = spark, wh.path("state", table)

    def read(self) -> tuple[dict[str, set[str]], dict[str, object]]:
        df = read_if_written(self.spark, self.path)
        if df is None:
            return {}, {}
        if "batch" not in df.columns:  # written before batches were kept
            df = df.withColumn("batch", F.lit(None).cast("string"))
        got = df.groupBy("input").agg(F.max("mark").alias("mark"), F.collect_set("batch").alias("batches")).collect()
        return {r["input"]: set(r["batches"]) for r in got}, {r["input"]: r["mark"] for r in got}

    def commit(self, batches: dict[str, set[str]], marks: dict[str, object]) -> None:
        rows = [(k, None, b) for k, bs in batches.items() for b in sorted(bs)]
        rows += [(k, v, None) for k, v in marks.items() if v is not None]
        if rows:
            (self.spark.createDataFrame(rows, "input string, mark timestamp, batch string").coalesce(1)
             .write.mode("append").parquet(self.path))


def news(inputs: dict[str, DataFrame], batches: dict[str, set[str]], marks: dict[str, object]):
    """(sessions with a row that the table has not taken yet, new labels, new ingest
    times), an input at a time.

    With labels, "new" does not depend on clocks: rows loaded later with an equal or an
    older ``_ingested_at`` are found too.  The label is a partition column, so the test
    prunes whole folders and old files are not opened."""
    keys, labels, times = set(), {}, {}
    for name, df in inputs.items():
        if "_batch_id" in df.columns:
            known = batches.get(name, set())
            fresh = df.filter(~F.col("_batch_id").isin(*known)) if known else df
            found = fresh.select("session_key", "_batch_id").distinct().collect()  # keys and labels, no samples
            labels[name] = {r["_batch_id"] for r in found if r["_batch_id"] is not None}
        else:
            times[name] = df.agg(F.max("_ingested_at")).first()[0]
            fresh = df if marks.get(name) is None else df.filter(F.col("_ingested_at") > F.lit(marks[name]))
            found = fresh.select("session_key").distinct().collect()
        keys |= {r["session_key"] for r in found if r["session_key"] is not None}
    return sorted(keys), labels, times


def rebuild_telemetry(spark: SparkSession, wh: Warehouse, car, boundaries, location, distance, smap,
                      of1_drivers, driver_map, bucket: str | HotKeys | None = BUCKET) -> int:
    """M17 incremental: recompute whole affected sessions (so the lap slice
    and the change flag never restart mid-session) and overwrite just their
    partitions.  One plan at every size: samples are split by time.

    What is new is looked up for every input on its own before the rebuild and committed
    after it, so late GPS, distance or lap rows are picked up once and a run without
    news rebuilds nothing.  Returns the number of sessions rebuilt."""
    path = wh.path("marts", "lap_telemetry")
    inputs = {"car": car, "location": location, "distance": distance}
    if {"_ingested_at", "_batch_id"} & set(boundaries.columns):
        inputs["laps"] = boundaries
    state = Progress(spark, wh, "lap_telemetry")
    keys, labels, times = news(inputs, *state.read())
    if keys:
        def pick(df):  # prunes the (year, session) folders
            return df.filter(F.col("session_key").isin(keys))
        bucket = measured(bucket, M.TELEMETRY_KEYS, [pick(df) for df in (car, boundaries, location, distance)])
        samples = [STG.one_per_sample(pick(df)) for df in (car, location, distance)]
        out = M.lap_telemetry(samples[0], pick(boundaries), samples[1], samples[2], smap,
                              of1_drivers, driver_map, bucket=bucket)
        write_telemetry(out, path, mode="overwrite" if _exists(spark, path) else "append")
    state.commit(labels, times)
    return len(keys)


def run_marts(spark: SparkSession, wh: Warehouse, stg: dict[str, DataFrame], circuit_stats: DataFrame | None = None,
              min_headshot_season: int = 2023, bucket: str | HotKeys | None = BUCKET) -> None:
    """Build every intermediate model, dimension, fact and mart from staged inputs."""
    smap = M.session_map(stg["sessions"], stg["races"])
    materialise(smap, wh.path("intermediate", "session_map"))
    smap = spark.read.parquet(wh.path("intermediate", "session_map"))
    materialise(M.lap_boundaries(stg.get("telemetry_laps", stg["laps"])), wh.path("intermediate", "lap_boundaries"),
                sort_by=["session_key", "driver_number", "lap_start"])
    materialise(M.sprint_weekends(stg["sprint_results"]), wh.path("intermediate", "sprint_weekends"))

    circuits = M.dim_circuits(stg["circuits_raw"], circuit_stats)
    materialise(circuits, wh.path("marts", "dim_circuits"))
    drivers = M.dim_drivers(stg["drivers"], stg["driver_map"], stg["of1_drivers"], min_headshot_season)
    materialise(drivers, wh.path("marts", "dim_drivers"))
    constructors = M.dim_constructors(stg["constructors"])
    materialise(constructors, wh.path("marts", "dim_constructors"))
    materialise(M.dim_sessions(stg["sessions"], stg["races"], spark.read.parquet(wh.path("marts", "dim_circuits"))),
                wh.path("marts", "dim_sessions"))

    timed = stg["laps"].join(smap.select("session_key", "season", "round", "canonical_type"), "session_key")
    build_fact(spark, wh, "fact_race_results", M.driver_race_results(stg["results"], stg["driver_map"], smap, stg["laps"]),
               {"results": stg["results"], "timing": timed})
    build_fact(spark, wh, "fact_sprint_results", M.fact_sprint_results(stg["sprint_results"], stg["driver_map"], smap),
               {"results": stg["sprint_results"]})
    build_fact(spark, wh, "fact_laps", M.fact_laps(stg["jolpica_laps"], stg["driver_map"], smap, stg["laps"]),
               {"laps": stg["jolpica_laps"], "timing": timed})
    build_fact(spark, wh, "fact_qualifying", M.fact_qualifying(stg["qualifying"], stg["driver_map"], smap, stg["laps"]),
               {"qualifying": stg["qualifying"], "timing": timed})

    d = spark.read.parquet(wh.path("marts", "dim_drivers"))
    c = spark.read.parquet(wh.path("marts", "dim_constructors"))
    materialise(M.standings(stg["driver_standings"], stg["constructor_standings"], d, c), wh.path("marts", "standings"))
    fr = spark.read.parquet(wh.path("marts", "fact_race_results"))
    materialise(M.strategy(fr, stg["pit_stops"], stg["stints"]), wh.path("marts", "strategy"))
    fl = spark.read.parquet(wh.path("marts", "fact_laps"))
    materialise(M.lap_analysis(fl), wh.path("marts", "lap_analysis"))
    fq = spark.read.parquet(wh.path("marts", "fact_qualifying"))
    materialise(M.qualifying_summary(fq, spark.read.parquet(wh.path("marts", "dim_sessions")), d,
                                     stg["of1_drivers"], c), wh.path("marts", "qualifying_summary"))
    rebuild_telemetry(spark, wh, stg["car_data"], spark.read.parquet(wh.path("intermediate", "lap_boundaries")),
                      stg["location"], stg["distances"], smap, stg["of1_drivers"], stg["driver_map"], bucket=bucket)


def load_weekend(tables: dict[str, DataFrame], season: int, rnd: int) -> dict[str, DataFrame]:
    """Restrict every results-feed table to one race weekend."""
    return {k: v.filter((F.col("season") == season) & (F.col("round") == rnd)) for k, v in tables.items()}


def load_weekend_status(spark: SparkSession, wh: Warehouse, tables: dict[str, DataFrame], season: int,
                        rnd: int | None = None) -> DataFrame:
    """Append one weekend (or, with ``rnd=None``, a whole season) to each
    raw table; a failing table does not stop the others.  Returns one status
    row per table."""
    rows = []
    chosen = (load_weekend(tables, season, rnd) if rnd is not None
              else {k: v.filter(F.col("season") == season) for k, v in tables.items()})
    for name, df in chosen.items():
        try:
            df.write.mode("append").parquet(wh.path("raw", name))
            rows.append((name, "ok", None))
        except Exception as e:  # noqa: BLE001 - reported, not raised
            rows.append((name, "failed", str(e)[:500]))
    return spark.createDataFrame(rows, "table string, status string, error string")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """I8: read a table whose files gained nullable columns over time
    (older files yield NULL for the new columns)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def ensure_columns(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """I8: add missing columns with a typed default (``DEFAULT 0`` columns),
    and fill NULLs of present ones that came from older files."""
    for name, (type_, value) in defaults.items():
        lit = F.lit(value).cast(type_)
        df = df.withColumn(name, F.coalesce(F.col(name), lit) if name in df.columns else lit)
    return df


# --------------------------------------------------------------------------
# landing -> raw -> staging (the ingest log itself is racelake.streaming.ingest)

def _parsers():
    from racelake.sources import jolpica as J
    from racelake.sources import openf1 as O
    from racelake.sources.distance import parse_distance
    return {
        # raw table: (landing folder, parser)
        "seasons": ("results/seasons", J.parse_seasons),
        "circuits": ("results/circuits", J.parse_circuits),
        "constructors": ("results/constructors", J.parse_constructors),
        "drivers": ("results/drivers", J.parse_drivers),
        "races": ("results/races", J.parse_races),
        "results": ("results/results", J.parse_results),
        "qualifying": ("results/qualifying", J.parse_qualifying),
        "sprint_results": ("results/sprint", J.parse_sprint),
        "lap_times": ("results/laps", J.parse_lap_times),
        "pit_stops": ("results/pitstops", J.parse_pit_stops),
        "driver_standings": ("results/driverstandings", J.parse_driver_standings),
        "constructor_standings": ("results/constructorstandings", J.parse_constructor_standings),
        "sessions": ("timing/sessions", O.parse_sessions),
        "of1_drivers": ("timing/drivers", O.parse_drivers),
        "of1_laps": ("timing/laps", O.parse_laps),
        "pit": ("timing/pit", O.parse_pit),
        "stints": ("timing/stints", O.parse_stints),
        "intervals": ("timing/intervals", O.parse_intervals),
        "weather": ("timing/weather", O.parse_weather),
        "race_control": ("timing/race_control", O.parse_race_control),
        "car_data": ("timing/car_data", O.parse_car_data),
        "location": ("timing/location", O.parse_location),
        "car_telemetry": ("distance/samples", parse_distance),
        "season_drivers": ("results/drivers", J.parse_season_drivers),
    }


TELEMETRY_TABLES = ("car_data", "location", "car_telemetry")


def ingest_landing(spark: SparkSession, landing_root: str, wh: Warehouse, ingested_at: str | None = None,
                   tables: Sequence[str] | None = None, max_files_per_trigger: int | None = None) -> list[str]:
    """Take the new files of every landing folder into the raw tables; the runs of all
    tables go on side by side.  See ``streaming.ingest`` for the log, the layout and
    what happens to broken lines.  Returns the raw tables that got files."""
    from racelake.streaming.ingest import finish, raw_writer, start_feed
    done: set[str] = set()
    queries = []
    for name, (folder, parse) in _parsers().items():
        if tables is not None and name not in tables:
            continue
        write = raw_writer(wh, name, parse, name in TELEMETRY_TABLES, ingested_at,
                           on_batch=lambda _label, name=name: done.add(name))
        queries.append(start_feed(spark, wh, f"{landing_root.rstrip('/')}/{folder}", name, write,
                                  max_files_per_trigger=max_files_per_trigger))
    finish([q for q in queries if q is not None])
    return [n for n in _parsers() if n in done]


def rejects(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """table, file, n: lines that no parser could read."""
    out = None
    for name in _parsers():
        df = read_if_written(spark, wh.path("raw", f"_rejects/{name}"))
        if df is not None:
            n = df.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "file", "n")
            out = n if out is None else out.unionByName(n)
    return out if out is not None else spark.createDataFrame([], "table string, file string, n long")


def stage_all(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    """P1 staging views over the raw tables (lazy).  A table that was never loaded is an
    empty one of its own columns, so seasons without a timing feed run like all others."""
    none = spark.createDataFrame([], "json string")
    parsers = _parsers()

    def raw(n):
        df = wh.read(spark, "raw", n)
        if df is not None:
            return df
        if n == "driver_id_map":
            return spark.createDataFrame([], "season int, jolpica_driver_id string, openf1_driver_number int, updated_at timestamp")
        return parsers[n][1](none, "1970-01-01 00:00:00")

    views = {
        "races": ("races", STG.stg_races), "results": ("results", STG.stg_results),
        "sprint_results": ("sprint_results", STG.stg_sprint_results), "qualifying": ("qualifying", STG.stg_qualifying),
        "jolpica_laps": ("lap_times", STG.stg_jolpica_laps), "pit_stops": ("pit_stops", STG.stg_pit_stops),
        "drivers": ("drivers", STG.stg_drivers), "constructors": ("constructors", STG.stg_constructors),
        "driver_standings": ("driver_standings", STG.stg_driver_standings),
        "constructor_standings": ("constructor_standings", STG.stg_constructor_standings),
        "sessions": ("sessions", STG.stg_sessions), "laps": ("of1_laps", STG.stg_of1_laps),
        "stints": ("stints", STG.stg_stints), "of1_drivers": ("of1_drivers", STG.stg_of1_drivers),
        "car_data": ("car_data", STG.stg_car_data), "location": ("location", STG.stg_location),
        "distances": ("car_telemetry", STG.stg_distances), "circuits_raw": ("circuits", lambda d: d),
        "driver_map": ("driver_id_map", lambda d: d),
        "seasons": ("seasons", STG.stg_seasons), "of1_pit": ("pit", STG.stg_of1_pit),
        "intervals": ("intervals", STG.stg_intervals), "weather": ("weather", STG.stg_weather),
        "race_control": ("race_control", STG.stg_race_control),
    }
    return {view: fn(raw(table)) for view, (table, fn) in views.items()}


MART_TABLES = {
    "intermediate": ["session_map", "lap_boundaries", "sprint_weekends"],
    "marts": ["dim_circuits", "dim_drivers", "dim_constructors", "dim_sessions", "fact_race_results",
              "fact_sprint_results", "fact_laps", "fact_qualifying", "standings", "strategy", "lap_analysis",
              "qualifying_summary", "lap_telemetry"],
}


def register_marts(spark: SparkSession, wh: Warehouse) -> list[str]:
    """Expose the written marts as temporary views under their model names
    (analytics marts with a ``mart_`` prefix), so existing dashboard / app SQL
    runs through ``spark.sql`` against the same tables; reads of the
    telemetry mart keep partition pruning on ``session_key``."""
    names = []
    for layer, tables in MART_TABLES.items():
        for t in tables:
            df = wh.read(spark, layer, t)
            if df is None:
                continue
            view = t if t.startswith(("dim_", "fact_")) else (f"int_{t}" if layer == "intermediate" else f"mart_{t}")
            df.createOrReplaceTempView(view)
            names.append(view)
    return names


def build_driver_map(spark: SparkSession, wh: Warehouse, updated_at: str | None = None) -> DataFrame | None:
    """S24 over the raw tables: race numbers per (season, driver) from the
    results, permanent numbers of that season's drivers as fill-ins; written
    as the bridge table (full refresh, one row per season and driver)."""
    from racelake.sources.bridge import driver_number_bridge
    res, drv = wh.read(spark, "raw", "results"), wh.read(spark, "raw", "drivers")
    if res is None:
        return None
    nums = res.select("season", "round", "driver_id", "number")
    season_drivers = res.select("season", "driver_id").distinct()
    listed = wh.read(spark, "raw", "season_drivers")
    if listed is not None:  # practice-only drivers are on a season's list, not in its results
        season_drivers = season_drivers.unionByName(listed.where("season is not null").select("season", "driver_id")).distinct()
    perm = (season_drivers.join(STG.stg_drivers(drv).select("driver_id", "permanent_number"), "driver_id")
            if drv is not None else season_drivers.withColumn("permanent_number", F.lit(None).cast("int")))
    ts = F.lit(updated_at).cast("timestamp") if updated_at else F.current_timestamp()
    bridge = driver_number_bridge(nums, perm).withColumn("updated_at", ts)
    materialise(bridge, wh.path("raw", "driver_id_map"))
    return wh.read(spark, "raw", "driver_id_map")


def run_all(spark: SparkSession, landing_root: str, wh: Warehouse, ingested_at: str | None = None,
            circuit_stats: DataFrame | None = None, check: bool = True) -> None:
    """Landing pages -> raw tables -> bridge -> staging -> marts -> data tests (the
    run fails with the failing rows named)."""
    from racelake.operators.lookups import circuit_stats as constants
    ingest_landing(spark, landing_root, wh, ingested_at)
    build_driver_map(spark, wh, ingested_at)
    stg = stage_all(spark, wh)
    run_marts(spark, wh, stg, circuit_stats if circuit_stats is not None else constants(spark))
    if check:
        from racelake.plans.data_tests import assert_data_tests
        tables = {n: wh.read(spark, "marts", n) for n in MART_TABLES["marts"]}
        tables["sessions"] = stg.get("sessions")
        assert_data_tests(spark, {n: df for n, df in tables.items() if df is not None})
