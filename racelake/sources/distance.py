"""Distance-along-track samples -> raw distance table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions.casts import parse_ts

#: A landing page: the samples of one session and driver.
PAGE = ("struct<session_key:int,driver_number:int,"
        "samples:array<struct<Date:string,Distance:double>>>")


def parse_distance(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Landing pages (column ``json``) -> raw distance rows."""
    rows = (df.select(F.from_json("json", PAGE).alias("p")).select("p.session_key", "p.driver_number", F.explode("p.samples").alias("s"))
            .select("session_key", "driver_number", parse_ts(F.col("s.Date"), "MILLISECOND").alias("Date"), F.col("s.Distance").alias("Distance")))
    return clean_distance(rows, ingested_at=ingested_at)


def clean_distance(df: DataFrame, date_col: str = "Date", dist_col: str = "Distance",
                   session_key=None, driver_number=None, ingested_at: str | None = None) -> DataFrame:
    """Drop NaN / NULL / negative distances, stamp the session and driver keys
    (columns already present, or constants for a single-lap frame), keep
    millisecond time.  An empty input gives an empty, typed output."""
    sk = F.col("session_key") if session_key is None else F.lit(session_key)
    dn = F.col("driver_number") if driver_number is None else F.lit(driver_number)
    d = F.col(dist_col)
    ok = d.isNotNull() & ~F.isnan(d) & (d >= 0)
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    return df.filter(ok).select(
        sk.cast("int").alias("session_key"), dn.cast("int").alias("driver_number"),
        F.date_trunc("MILLISECOND", F.col(date_col)).alias("date"), d.cast("double").alias("distance_m"),
        ts.alias("_ingested_at"))
