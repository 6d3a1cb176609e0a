"""As-of (latest preceding row) joins without a per-row lookup.

Spark has no public DataFrame as-of join.  Instead of a range join (which
fans out) or a lateral ``LIMIT 1`` subquery (quadratic), every input is
unioned into one frame, hash-partitioned once on the ``by`` keys and sorted
once by time; a running ``last(struct, ignoreNulls)`` window then carries the
latest right-side row forward to each left row.  Several right inputs are
resolved in the same shuffle and the same sort.

Rules
  * inclusive bound (``right.ts <= left.ts``): right rows sort before left
    rows at equal time; ``inclusive=False`` flips that for ``<``.
  * the right payload is carried as a struct, so a matched row whose fields
    are all NULL still counts as a match.
  * ties on the right (same key and time) resolve deterministically: the
    largest payload struct wins (same rule in the bucketed path).
  * the output keeps the ``by`` keys and the left time as the very columns
    the exchange and sort ran on, so a following window over the same keys
    ordered by the same time (e.g. a change flag) needs no new shuffle or sort.
  * left rows whose key or time is NULL can never match; they bypass the
    window (no hot NULL partition) and come back with NULL right columns,
    or are dropped when ``keep_unmatchable=False``.
  * ``bucket``: how one key is spread over many tasks.  Partitions become
    ``(by, bucket)``; the latest right row of earlier buckets is carried over
    exactly by one summary row a bucket, so results equal the unbucketed join.
    A time width cuts every key.  ``HotKeys`` cuts only keys that hold too many rows:
    they are counted first (two columns of the inputs, summed before the shuffle), so
    all other keys stay in one piece and neither they nor the carry cost anything more.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_T = "__asof_t"
_SIDE = "__asof_side"
_B = "__asof_b"
_L = "__asof_left"


@dataclass
class AsofRight:
    """One right-hand input of an as-of join."""

    df: DataFrame
    ts: str
    cols: Sequence[str]
    # output names of ``cols`` (defaults to the same names)
    rename: dict = field(default_factory=dict)
    # names of the by-keys on this side if they differ from the left's
    by: Sequence[str] | None = None


@dataclass(frozen=True)
class HotKeys:
    """Cut keys of more than ``rows`` rows by time, into pieces of about that many if
    they come evenly (uneven ones give uneven pieces, never other results)."""

    rows: int = 4_000_000


def measured(bucket, by: Sequence[str], inputs: Sequence[DataFrame]):
    """``bucket`` for a join of these inputs: None if it is ``HotKeys`` and no key has more
    rows than that.  One pass over the key columns, summed before the shuffle; the plan
    for hot keys, which costs more stages, is then only built where there are any."""
    if not isinstance(bucket, HotKeys):
        return bucket
    rows = None
    for df in inputs:
        k = df.select(*by)
        rows = k if rows is None else rows.unionByName(k)
    hot = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > bucket.rows)
    return None if hot.isEmpty() else bucket


def _bucket_expr(ts: Column, bucket_us: int) -> Column:
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.floor(micros / F.lit(bucket_us)).cast("long")


def parse_bucket(bucket: str | int | None) -> int | None:
    """'15 minutes' / '1 hour' / seconds as int -> microseconds."""
    if bucket is None:
        return None
    if isinstance(bucket, int):
        return bucket * 1_000_000
    n, unit = bucket.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult * 1_000_000


def _payload_type(df: DataFrame, cols: Sequence[str]) -> T.StructType:
    """Struct type of ``cols`` from the input's (cached) schema, without
    analysing a derived plan."""
    sch = df.schema
    return T.StructType([T.StructField(c, sch[c].dataType, True) for c in cols])


def asof_join_many(
    left: DataFrame,
    by: Sequence[str],
    left_ts: str,
    rights: Sequence[AsofRight],
    inclusive: bool = True,
    bucket: str | int | HotKeys | None = None,
    keep_unmatchable: bool = True,
    emit_bucket: str | None = None,
) -> DataFrame:
    """Attach to every left row the latest row of each right input.

    Returns all left columns plus the (renamed) right columns; left rows with
    no preceding right row get NULLs (left-outer semantics).  In bucketed mode
    ``emit_bucket`` names an output column carrying the time bucket the rows
    are partitioned on, so a following bucketed window can reuse it.
    """
    by = list(by)
    left_side, right_side = (1, 0) if inclusive else (0, 1)
    left_cols = left.columns
    rest = [c for c in left_cols if c not in by and c != left_ts]
    rtypes = [_payload_type(r.df, r.cols) for r in rights]
    rcols = [f"__r{i}" for i in range(len(rights))]

    valid = F.col(left_ts).isNotNull()
    for k in by:
        valid = valid & F.col(k).isNotNull()

    left_payload = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(None).cast("int").alias("__none"))
    ltype = _payload_type(left, rest) if rest else T.StructType([T.StructField("__none", T.IntegerType(), True)])
    parts = [
        left.filter(valid).select(
            *[F.col(k) for k in by], F.col(left_ts).alias(_T), F.lit(left_side).alias(_SIDE),
            left_payload.alias(_L), *[F.lit(None).cast(t).alias(c) for t, c in zip(rtypes, rcols)])
    ]
    for i, r in enumerate(rights):
        rby = list(r.by) if r.by else by
        rvalid = F.col(r.ts).isNotNull()
        for rk in rby:
            rvalid = rvalid & F.col(rk).isNotNull()
        structs = [F.struct(*[F.col(c) for c in r.cols]).alias(c) if j == i else F.lit(None).cast(t).alias(c)
                   for j, (t, c) in enumerate(zip(rtypes, rcols))]
        parts.append(r.df.filter(rvalid).select(
            *[F.col(rk).alias(k) for rk, k in zip(rby, by)], F.col(r.ts).alias(_T),
            F.lit(right_side).alias(_SIDE), F.lit(None).cast(ltype).alias(_L), *structs))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    order = [F.col(_T), F.col(_SIDE)] + [F.col(c) for c in rcols]
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        got = u.select(
            *[F.col(k) for k in by], F.col(_T), F.col(_SIDE), F.col(_L),
            *[F.last(F.col(c), ignorenulls=True).over(w).alias(c) for c in rcols],
        ).filter(F.col(_SIDE) == left_side)
    else:
        if isinstance(bucket, HotKeys):
            u = _hot_pieces(u, by, bucket.rows)
        else:
            u = u.withColumn(_B, _bucket_expr(F.col(_T), parse_bucket(bucket)))
        got = _bucketed(u, by, rcols, order, left_side)

    # keys and time stay the exchanged / sorted columns; everything else
    # is unpacked from the carried structs
    out = []
    for c in left_cols:
        if c in by:
            out.append(F.col(c))
        elif c == left_ts:
            out.append(F.col(_T).alias(c))
        else:
            out.append(F.col(f"{_L}.{c}").alias(c))
    for i, r in enumerate(rights):
        out += [F.col(f"__r{i}.{c}").alias(r.rename.get(c, c)) for c in r.cols]
    if emit_bucket and bucket is not None:
        out.append(F.col(_B).alias(emit_bucket))
    res = got.select(*out)

    if keep_unmatchable:
        rest_right = [F.lit(None).cast(rtypes[i][c].dataType).alias(r.rename.get(c, c))
                      for i, r in enumerate(rights) for c in r.cols]
        res = res.unionByName(left.filter(~valid).select(*left_cols, *rest_right))
    return res


def _hot_pieces(u: DataFrame, by: list[str], rows: int) -> DataFrame:
    """Add the bucket: null for keys of at most ``rows`` rows, else the piece by time."""
    micros = F.unix_micros(F.col(_T).cast("timestamp"))
    size = u.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min(micros).alias("__lo"), F.max(micros).alias("__hi"))
    width = F.greatest(F.lit(1.0), (F.col("__hi") - F.col("__lo")) / F.ceil(F.col("__n") / F.lit(rows)))
    hot = size.filter(F.col("__n") > rows).select(*by, "__lo", width.alias("__width"))
    # at most one row for every ``rows`` rows of the inputs
    cut = u.join(F.broadcast(hot), by, "left")
    return cut.withColumn(_B, F.floor((micros - F.col("__lo")) / F.col("__width"))).drop("__lo", "__width")


def _bucketed(u, by, rcols, order, left_side):
    """Two-level as-of: inside (key, bucket) by window, across buckets by a carry table.
    Keys without a bucket (null) are in one piece and have no carry."""
    w = Window.partitionBy(*by, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = u.select(
        *[F.col(k) for k in by], F.col(_B), F.col(_T), F.col(_SIDE), F.col(_L),
        *[F.last(F.col(c), ignorenulls=True).over(w).alias(c) for c in rcols],
    ).filter(F.col(_SIDE) == left_side)

    # latest right row per (key, bucket): a map-side-combined aggregate whose
    # size is (#keys x #buckets), independent of the rows per key.
    per_bucket = u.filter(F.col(_B).isNotNull()).groupBy(*by, _B).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(_T).alias("t"), F.col(c).alias("v")))).alias(c)
        for c in rcols])
    wb = Window.partitionBy(*by).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        *[F.col(k) for k in by], F.col(_B),
        *[F.last(F.col(c + ".v"), ignorenulls=True).over(wb).alias(c + "_carry") for c in rcols],
    )
    j = inner.join(carry, on=[*by, _B], how="left")
    return j.select(
        *[F.col(k) for k in by], F.col(_B), F.col(_T), F.col(_SIDE), F.col(_L),
        *[F.coalesce(F.col(c), F.col(c + "_carry")).alias(c) for c in rcols],
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    rename: dict | None = None,
    inclusive: bool = True,
    bucket: str | int | HotKeys | None = None,
    keep_unmatchable: bool = True,
) -> DataFrame:
    """Single-input convenience wrapper of :func:`asof_join_many`."""
    return asof_join_many(
        left, by, left_ts,
        [AsofRight(right, right_ts, list(right_cols), rename or {})],
        inclusive=inclusive, bucket=bucket, keep_unmatchable=keep_unmatchable,
    )
