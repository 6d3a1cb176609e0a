"""Window operators: change flags, deltas to the best, ordinals.

Group statistics (min / mean of a group attached to each row) are computed
as an aggregate joined back on the group keys rather than as a window:
the aggregate combines map-side, is small (one row per group) and AQE
broadcasts it after measuring its size, so the wide side is not shuffled at
all and a hot group is never sorted inside one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelake.operators.asof import _bucket_expr, parse_bucket


def change_flag(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str], name: str,
                bucket: str | int | None = None, bucket_col: str | None = None) -> DataFrame:
    """1 when any of ``cols`` differs from the previous row in the group,
    else 0.  Missing values and the first row's predecessor count as 0; rows of
    equal ``order`` follow each other by ``cols``.

    ``bucket`` (time width, for a time ``order``): the lag runs inside
    ``(by, bucket)`` partitions; the first row of a bucket compares with the
    last row of the nearest earlier bucket, found from a one-row-per-bucket
    aggregate, so a single huge group is spread over many tasks exactly.
    ``bucket_col`` reuses a bucket column already present (e.g. emitted by a
    bucketed as-of join), keeping its partitioning and sort order; groups where it
    is null are in one piece and need no carry."""
    vals = [F.coalesce(F.col(c), F.lit(0)) for c in cols]
    if bucket is None and bucket_col is None:
        w = Window.partitionBy(*by).orderBy(order, *cols)
        prevs = [F.lag(v, 1, 0).over(w) for v in vals]
        return df.withColumn(name, _any_diff(vals, prevs))

    if bucket_col:
        b, d = bucket_col, df
    else:
        b = "__cf_b"
        d = df.withColumn(b, _bucket_expr(F.col(order), parse_bucket(bucket)))
    last = (d.filter(F.col(b).isNotNull()).groupBy(*by, b)
            .agg(F.max_by(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(vals)]), F.struct(order, *cols)).alias("__last")))
    wb = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*by, b, F.last("__last", ignorenulls=True).over(wb).alias("__carry"))
    w = Window.partitionBy(*by, b).orderBy(order, *cols)
    d = d.join(carry, [*by, b], "left")
    prevs = [F.coalesce(F.lag(v, 1).over(w), F.col(f"__carry.v{i}"), F.lit(0)) for i, v in enumerate(vals)]
    out = d.withColumn(name, _any_diff(vals, prevs)).drop("__carry")
    return out if bucket_col else out.drop(b)


def _any_diff(vals, prevs):
    changed = None
    for v, p in zip(vals, prevs):
        e = v != p
        changed = e if changed is None else (changed | e)
    return changed.cast("int")


def _group_stat(df: DataFrame, group: Sequence[str], agg, name: str) -> DataFrame:
    stat = df.groupBy(*group).agg(agg.alias(name))
    # NULL group keys form a group of their own, as in a window
    cond = [df[g].eqNullSafe(stat[g]) for g in group]
    return df.join(stat, cond, "left").select(df["*"], stat[name])


def delta_to_best(df: DataFrame, group: Sequence[str], value: str, best: str, delta: str) -> DataFrame:
    """Group minimum and the difference to it."""
    return _group_stat(df, group, F.min(value), best).withColumn(delta, F.col(value) - F.col(best))


def group_mean(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Group average."""
    return _group_stat(df, group, F.avg(value), name)


def rows_at_group_min(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows whose ``value`` equals their group's minimum (all ties kept),
    i.e. ``x = (SELECT min(x) ... same group)``."""
    stat = df.groupBy(*group).agg(F.min(value).alias("__min"))
    return df.join(stat, [df[g] == stat[g] for g in group] + [df[value] == stat["__min"]], "left_semi")


def ordinal(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1..n within ``by`` after sorting by ``order``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("int"))
