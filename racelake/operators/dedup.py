"""Latest-version reads, best rows and priority lookups.

All of these are "one row per group" selections.  They are written as a
``row_number()`` window filtered to 1, which Catalyst turns into a
``WindowGroupLimit`` below the exchange so each task keeps only its local
best row per group before shuffling; or, where the whole row is not needed,
as a ``max(struct)`` aggregate with map-side partial aggregation.  Neither
collects a group into memory, so a hot key costs time, not memory.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order`` (a total order
    should be supplied by the caller; ties otherwise break arbitrarily)."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """K1: the row with the greatest ``version`` per key (a replacing table's
    final state).  ``tiebreak`` columns (descending) make equal versions
    deterministic."""
    order = [F.col(version).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    return first_per_group(df, keys, order)


def main_per_group(df: DataFrame, keys: Sequence[str], ts: str, flag: str = "is_main") -> DataFrame:
    """K2: mark the latest row per group (e.g. the main race of a meeting when
    sprint weekends carry two sessions of one type) without dropping rows."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), F.col(ts).isNull())
    return df.withColumn(flag, (F.row_number().over(w) == 1))


def best_row(df: DataFrame, keys: Sequence[str], metric: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Smallest non-null ``metric`` per group; rows with NULL metric never win."""
    order = [F.col(metric).asc()] + [F.col(c).asc() for c in tiebreak]
    return first_per_group(df.filter(F.col(metric).isNotNull()), keys, order)


def deterministic_any(df: DataFrame, keys: Sequence[str], cols: Sequence[str], version: str | None = None) -> DataFrame:
    """A4: replacement for ``any()``: one value set per group, taken from the
    latest ``version`` row (or the smallest row when no version exists).

    Implemented as ``max_by``/``min`` over a struct so it partially
    aggregates map-side: output is one row per group."""
    payload = F.struct(*[F.col(c) for c in cols])
    if version is None:
        agg = F.min(payload).alias("__p")
    else:
        agg = F.max_by(payload, F.struct(F.col(version), payload)).alias("__p")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"__p.{c}").alias(c) for c in cols])


def priority_lookup(
    cand: DataFrame,
    index: DataFrame,
    group_keys: Sequence[str],
    join_keys: Sequence[str],
    option_col: str,
    priority_col: str,
    value_cols: Sequence[str],
) -> DataFrame:
    """K3: first match in a priority list.

    ``cand`` has one row per (request, acceptable option) with the option's
    ``priority`` (lower wins); ``index`` maps ``join_keys`` + ``option_col`` to
    ``value_cols``.  Returns one row per ``group_keys`` with the values of the
    best present option, NULL when none is present.  Equi join + min(struct)
    aggregate: no per-request loop, no collect.
    """
    idx = index.select(*join_keys, option_col, *value_cols).withColumn("__hit", F.lit(True))
    j = cand.join(idx, on=[*join_keys, option_col], how="left")
    found = F.when(F.col("__hit"), F.struct(F.col(priority_col).alias("p"),
                                            F.struct(*[F.col(c) for c in value_cols]).alias("v")))
    g = j.groupBy(*group_keys).agg(F.min(found).alias("__best"))
    return g.select(*group_keys, *[F.col(f"__best.v.{c}").alias(c) for c in value_cols])
