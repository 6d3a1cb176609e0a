"""Split a time range into fixed windows (backfill work list / buckets)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_chunks(ranges: DataFrame, keys: Sequence[str], start: str, end: str, minutes: int = 30) -> DataFrame:
    """One row per ``[chunk_start, chunk_end)`` window of ``minutes`` covering
    ``[start, end)``; the last window is clipped at ``end``.  ``sequence``
    + ``explode`` runs per row inside the tasks (no driver loop)."""
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    c = ranges.select(*keys, F.col(end).alias("__e"),
                      F.explode(F.sequence(F.col(start), F.col(end), step)).alias("chunk_start"))
    return (c.filter(F.col("chunk_start") < F.col("__e"))
            .select(*keys, "chunk_start", F.least(F.col("chunk_start") + step, F.col("__e")).alias("chunk_end")))
