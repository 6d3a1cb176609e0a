"""Interval boundaries and interval slicing (lap windows over samples)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelake.operators.asof import AsofRight, asof_join_many


def interval_bounds(df: DataFrame, by: Sequence[str], order: str, start: str, end: str = "end") -> DataFrame:
    """``end`` = the next row's ``start`` within ``by`` ordered by ``order``;
    the last interval stays open (NULL end).  Rows of equal ``order`` follow
    each other by ``start``."""
    w = Window.partitionBy(*by).orderBy(order, start)
    return df.withColumn(end, F.lead(F.col(start)).over(w))


def slice_intervals(
    samples: DataFrame,
    intervals: DataFrame,
    by: Sequence[str],
    sample_ts: str,
    start: str,
    end: str,
    cols: Sequence[str],
    bucket: str | int | None = None,
) -> DataFrame:
    """Assign each sample to the interval ``[start, end)`` that contains it.

    Done as an as-of join on ``start`` followed by the ``end`` test, so a
    sample never fans out to several intervals and no range join is planned.
    Samples before the first start are dropped; the last interval is open.
    """
    got = asof_join_many(
        samples, by, sample_ts,
        [AsofRight(intervals, start, [*cols, end], {})], bucket=bucket,
    )
    return got.filter(F.col(cols[0]).isNotNull() & (F.col(end).isNull() | (F.col(sample_ts) < F.col(end))))
