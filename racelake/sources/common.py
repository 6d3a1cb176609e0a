"""Shared helpers for landing-page parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pages(df: DataFrame, schema: T.DataType, json_col: str = "json") -> DataFrame:
    """Parse one landing page per row with an explicit schema (column ``p``)."""
    return df.select(F.from_json(F.col(json_col), schema).alias("p"))


def stamp(df: DataFrame, ingested_at: str | None = None, raw: Column | None = None) -> DataFrame:
    """Add ``_ingested_at`` (the batch time, or now) and ``_raw_json``."""
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    out = df.withColumn("_ingested_at", ts)
    if raw is not None:
        out = out.withColumn("_raw_json", raw)
    return out


def num(c: Column, t: str) -> Column:
    """Text -> number, NULL when empty or not a number (Python ``x or None`` / ``int()``)."""
    return F.nullif(F.trim(c), F.lit("")).try_cast(t)


def digits(c: Column) -> Column:
    """``int(x) if x.isdigit() else None``."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def text(c: Column, default: str = "") -> Column:
    """``r.get(k, default)``."""
    return F.coalesce(c, F.lit(default))


def text_or(c: Column, default: str = "") -> Column:
    """``r.get(k) or default`` (empty counts as missing)."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))
