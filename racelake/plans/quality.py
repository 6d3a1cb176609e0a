"""Data-quality checks.  Each returns the failing rows: pass = empty frame."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    """D1."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys appearing more than once, with their count (partial
    aggregation before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """D3: child rows whose non-null key has no parent (left anti join on
    the distinct parent keys)."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the accepted list."""
    return df.filter(~F.col(col).isin(*values) | F.col(col).isNull()).select(col).distinct()


def no_future(df: DataFrame, date_col: str, as_of: str) -> DataFrame:
    """Rows dated after ``as_of`` (a parameter, never the wall clock)."""
    return df.filter(F.col(date_col) > F.lit(as_of).cast("date"))


def sample_rate_outliers(samples: DataFrame, keys: Sequence[str], ts: str,
                         low: float = 3.5, high: float = 4.0, min_seconds: int = 60) -> DataFrame:
    """Groups longer than ``min_seconds`` whose mean sample rate is outside
    ``[low, high]`` Hz.  Duration counts whole-second boundaries crossed
    (F10), the rate is samples / duration."""
    g = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        (F.unix_timestamp(F.max(ts).cast("timestamp")) - F.unix_timestamp(F.min(ts).cast("timestamp")))
        .alias("duration_seconds"))
    g = g.withColumn("hz", F.when(F.col("duration_seconds") > 0,
                                  F.col("sample_count") / F.col("duration_seconds")).otherwise(F.lit(0.0)))
    return g.filter(F.col("duration_seconds") > min_seconds).filter((F.col("hz") < low) | (F.col("hz") > high))


def row_parity(a: DataFrame, b: DataFrame, name_a: str = "raw", name_b: str = "staged") -> DataFrame:
    """One row with both counts when they differ (empty when equal)."""
    ca = a.agg(F.count(F.lit(1)).alias(name_a)).withColumn("__k", F.lit(1))
    cb = b.agg(F.count(F.lit(1)).alias(name_b)).withColumn("__k", F.lit(1))
    return ca.join(cb, "__k").drop("__k").filter(F.col(name_a) != F.col(name_b))


def boundary_consistency(boundaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lap windows whose end is not the next lap's start."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("lap_number")
    nxt = F.lead("lap_start").over(w)
    return (boundaries.withColumn("__next", nxt)
            .filter(~F.col("lap_end").eqNullSafe(F.col("__next"))).drop("__next"))
