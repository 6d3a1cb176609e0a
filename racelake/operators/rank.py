"""T1/W5 over a whole table: global ranks and running sums without a one-task window.

Rows are range-partitioned by the order, sorted inside each partition and written
once with their place (partition, row).  A partition's count is one summary row; the
prefix sums of these rows give every partition its offset, so a row's rank is its
place plus the offset.  Range borders may fall between rows of equal order, so a
single value that holds a third of all rows is spread as well.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelake.session import ensure_checkpoint_dir

#: ``monotonically_increasing_id`` holds the partition above this many bits of row number.
_ROW_BITS = 33


def _name(taken: Sequence[str], wanted: str) -> str:
    """A column name that no input column has (names are compared without case)."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def placed(df: DataFrame, order: Sequence[str | Column], part: str, row: str, folder: str | None = None) -> DataFrame:
    """``df`` sorted over the whole table and written, with each row's partition and
    its number (from 0) inside it.

    The table goes to a new folder under ``folder`` (default: the session's shared
    checkpoint folder), which outlives the loss of any executor; it is left there."""
    spark = df.sparkSession
    spot = _name(df.columns, "place")
    base = folder or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/placed/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(spot, F.monotonically_increasing_id())
    out.write.parquet(path)
    kept = spark.read.schema(out.schema).parquet(path)
    return kept.select(*df.columns, F.shiftright(spot, _ROW_BITS).alias(part),
                       F.col(spot).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(row))


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str, folder: str | None = None) -> DataFrame:
    """``df`` plus ``name`` (long): 1, 2, 3 ... in the given order over all rows.

    Rows that agree in the whole order get successive ranks in an order of their own.
    An empty table stays empty."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"{name} is a column of the input")
    part, row, offset = [_name([*df.columns, name], c) for c in ("part", "row", "offset")]
    rows = placed(df, order, part, row, folder)
    # one row a partition: this window and the broadcast are bounded by the partition count
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias(offset))
    starts = counts.select(part, F.coalesce(F.sum(offset).over(before), F.lit(0)).alias(offset))
    return rows.join(F.broadcast(starts), part).select(*df.columns, (F.col(row) + F.col(offset) + 1).alias(name))
