"""I7 + S26: what the timing feed owes the raw tables, and what is there.

A unit is one feed of one finished session, for telemetry one time window of it; telemetry
is owed by eligible sessions alone (type rule).  ``WorkList.check`` compares the units that
are not done yet with the rows of the raw tables and records each as done or missing, so a
later check looks at the missing ones again and never at the done ones.  ``pending`` is the
list for whoever fetches pages.  The status table has a row a unit and check, appended.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.plans.pipeline import (
    TELEMETRY_TYPES,
    Warehouse,
    _parsers,
    eligible_sessions,
    read_if_written,
)
from racelake.sources.chunks import time_chunks
from racelake.streaming.ingest import write_label

#: Feeds of every finished session, and those of telemetry sessions.
SESSION_FEEDS = ("of1_laps", "pit", "stints", "intervals", "weather", "race_control")
WINDOW_FEEDS = ("car_data", "location")
UNIT = ["session_key", "feed", "window_start"]


def units(sessions: DataFrame, as_of: str, types: Sequence[str] = TELEMETRY_TYPES, minutes: int = 30) -> DataFrame:
    """session_key, feed, window_start, window_end: all that is owed as of a time.

    ``sessions``: session_key, session_type, date_start, date_end (timestamps)."""
    def feeds(names):
        return F.explode(F.array(*[F.lit(n) for n in names])).alias("feed")
    ended = sessions.filter(F.col("date_end") < F.lit(as_of).cast("timestamp"))
    whole = ended.select("session_key", F.col("date_start").alias("window_start"), F.col("date_end").alias("window_end"), feeds(SESSION_FEEDS))
    chosen = eligible_sessions(sessions, as_of, types).filter(F.col("date_start").isNotNull())
    windows = time_chunks(chosen, ["session_key"], "date_start", "date_end", minutes)
    parts = windows.select("session_key", F.col("chunk_start").alias("window_start"), F.col("chunk_end").alias("window_end"), feeds(WINDOW_FEEDS))
    return whole.unionByName(parts).select("session_key", "feed", "window_start", "window_end")


class WorkList:
    """The status table of one warehouse."""

    def __init__(self, spark: SparkSession, wh: Warehouse):
        self.spark, self.wh, self.path = spark, wh, wh.path("state", "worklist")

    def status(self) -> DataFrame:
        """Latest state of every unit that was checked: status, attempts."""
        log = read_if_written(self.spark, self.path)
        if log is None:
            return self.spark.createDataFrame([], "session_key long, feed string, window_start timestamp, status string, attempts long")
        return log.groupBy(*UNIT).agg(F.max_by("status", "checked").alias("status"), F.count(F.lit(1)).alias("attempts"))

    def todo(self, owed: DataFrame) -> DataFrame:
        """Units that are not done."""
        done = self.status().filter("status = 'done'").select(*UNIT)
        return owed.join(done, UNIT, "left_anti")

    def check(self, owed: DataFrame, checked: int) -> None:
        """Look up the units that are not done; ``checked`` numbers the check (rising)."""
        todo = self.todo(owed.withColumn("session_key", F.col("session_key").cast("long")))
        there = None
        for feed in (*SESSION_FEEDS, *WINDOW_FEEDS):
            raw = self.wh.read(self.spark, "raw", feed)
            if raw is None:
                continue
            mine = todo.filter(F.col("feed") == feed)
            if feed in WINDOW_FEEDS:
                # at most one row a second and session goes on: presence, not samples
                seen = raw.select(F.col("session_key").cast("long").alias("session_key"), F.date_trunc("second", "date").alias("at")).distinct()
                found = mine.join(seen, "session_key").filter((F.col("at") >= F.date_trunc("second", "window_start")) & (F.col("at") < F.col("window_end")))
            else:
                seen = raw.select(F.col("session_key").cast("long").alias("session_key")).distinct()
                found = mine.join(seen, "session_key", "left_semi")
            found = found.select(*UNIT).distinct()
            there = found if there is None else there.unionByName(found)
        if there is None:
            there = todo.select(*UNIT).limit(0)
        log = todo.join(there.withColumn("held", F.lit("done")), UNIT, "left").select(
            *UNIT, F.coalesce("held", F.lit("missing")).alias("status"), F.lit(checked).cast("long").alias("checked"))
        log.coalesce(1).write.mode("append").parquet(self.path)

    def pending(self, owed: DataFrame) -> DataFrame:
        """Units to fetch, with the number of checks that missed them."""
        return self.todo(owed).join(self.status().select(*UNIT, "attempts"), UNIT, "left").fillna(0, ["attempts"])


def load_session(spark: SparkSession, landing_root: str, wh: Warehouse, session_key: int, as_of: str,
                 skip_telemetry: bool = False, ingested_at: str | None = None) -> DataFrame:
    """Load exactly one timing session from its landed pages: nothing before it has ended,
    telemetry only for the eligible types.  Returns feed, status (loaded, skipped, absent or
    failed), error; one feed's failure does not stop the others, and a repeated load
    replaces its own rows."""
    from racelake.plans import staging as STG
    from racelake.sources.openf1 import write_telemetry
    raw = wh.read(spark, "raw", "sessions")
    known = None if raw is None else STG.stg_sessions(raw).filter(F.col("session_key") == session_key)
    ended = known is not None and not known.filter(F.col("date_end") < F.lit(as_of).cast("timestamp")).isEmpty()
    telemetry = ended and not skip_telemetry and not eligible_sessions(known, as_of).isEmpty()
    label, rows = f"s{session_key}", []
    for feed in ("of1_drivers", *SESSION_FEEDS, *WINDOW_FEEDS):
        folder, parse = _parsers()[feed]
        if not ended or (feed in WINDOW_FEEDS and not telemetry):
            rows.append((feed, "skipped", None))
            continue
        try:
            pages = _landed(spark, f"{landing_root.rstrip('/')}/{folder}")
            if pages is None:
                rows.append((feed, "absent", None))
                continue
            mine = parse(pages, ingested_at).filter(F.col("session_key") == session_key)
            if feed in WINDOW_FEEDS:
                write_telemetry(mine.withColumn("_batch_id", F.lit(label)), wh.path("raw", feed), mode="overwrite")
            else:
                write_label(mine, label, wh.path("raw", feed))
            rows.append((feed, "loaded", None))
        except Exception as e:  # noqa: BLE001 - reported, not raised
            rows.append((feed, "failed", str(e)[:500]))
    return spark.createDataFrame(rows, "feed string, status string, error string")


def _landed(spark: SparkSession, folder: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.text(folder).withColumnRenamed("value", "json")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
