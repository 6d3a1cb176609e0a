"""Incremental loading: by watermark and by not-yet-loaded key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watermark(target: DataFrame | None, col: str = "_ingested_at") -> str | None:
    """The target's high watermark as text (exact to the microsecond and
    independent of the driver's local time zone), or None when empty."""
    if target is None:
        return None
    return target.agg(F.max(col).cast("string").alias("wm")).first()["wm"]


def after_watermark(source: DataFrame, target: DataFrame | None, col: str = "_ingested_at",
                    wm: str | None = None) -> DataFrame:
    """Rows of ``source`` strictly newer than the target's high watermark.

    The watermark is one scalar (a global ``max`` whose partial aggregates
    are combined map-side), read once and applied as a literal predicate so
    it is pushed into the source's parquet scan and prunes row groups.
    First run (no target, or an empty one) loads everything.  ``wm`` passes
    a watermark already read (several inputs against one target).
    """
    if wm is None:
        wm = watermark(target, col)
    if wm is None:
        return source
    return source.filter(F.col(col) > F.lit(wm).cast(source.schema[col].dataType))


def unseen_keys(source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose ``keys`` tuple is absent from ``target``.

    An equi ``left_anti`` join on the distinct loaded keys (pre-aggregated
    before the shuffle), never a tuple ``NOT IN`` (which plans as a nested
    loop when keys are nullable).
    """
    if target is None:
        return source
    loaded = target.select(*keys).distinct()
    return source.join(loaded, on=list(keys), how="left_anti")


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append a batch; an empty batch writes nothing."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """I4: replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def layout(df: DataFrame, partition_keys: Sequence[str], sort_keys: Sequence[str]) -> DataFrame:
    """Cluster rows by partition keys and sort within each file so
    readers prune partitions and row groups (min/max) on the sort keys."""
    return df.repartition(*partition_keys).sortWithinPartitions(*sort_keys)
