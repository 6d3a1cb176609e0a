"""Tolerance matching: closest candidate within +-k inside equi keys."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tolerance_match(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_val: str,
    right_val: str,
    tol: float,
    group_keys: Sequence[str],
    payload: Sequence[str],
    tiebreak: str,
) -> DataFrame:
    """J7 + A3: among right rows with ``|right_val - left_val| <= tol`` (sharing
    the equi ``keys``), keep per ``group_keys`` the one closest to the target.

    The whole winning row supplies every payload column (one
    ``min(struct(diff, tiebreak, payload))``), so columns cannot come from
    different rows; ties go to the lowest ``tiebreak``.  The equi keys drive
    a hash/sort-merge join, the tolerance is a residual filter, and the
    aggregation is partial (map-side) before its shuffle.
    """
    cond = [left[a] == right[b] for a, b in keys]
    diff = F.abs(right[right_val] - left[left_val])
    j = left.join(right, on=cond, how="inner").filter(left[left_val].isNotNull() & (diff <= F.lit(tol)))
    best = F.min(F.struct(diff.alias("__d"), right[tiebreak].alias("__tb"),
                          *[F.col(p).alias(p) for p in payload])).alias("__best")
    g = j.groupBy(*group_keys).agg(best)
    return g.select(*group_keys, *[F.col(f"__best.{p}").alias(p) for p in payload])
