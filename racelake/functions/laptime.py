"""Lap-time strings <-> milliseconds, as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted lap/duration text, ``M:SS.mmm`` or ``SS.mmm``
# (fraction of 1-3 digits, right-padded to milliseconds).  Anything else,
# including hour-qualified ``H:MM:SS.mmm``, parses to NULL.
LAP_TIME_PATTERN = r"^(?:([0-9]+):)?([0-9]+)\.([0-9]{1,3})$"


def parse_lap_time(c: Column | str) -> Column:
    """F1: ``'1:23.456'`` -> 83456, ``'22.5'`` -> 22500, bad text -> NULL."""
    s = F.trim(F.col(c) if isinstance(c, str) else c)
    ok = s.rlike(LAP_TIME_PATTERN)
    mins = F.regexp_extract(s, LAP_TIME_PATTERN, 1)
    secs = F.regexp_extract(s, LAP_TIME_PATTERN, 2)
    frac = F.rpad(F.regexp_extract(s, LAP_TIME_PATTERN, 3), 3, "0")
    ms = (
        F.coalesce(F.nullif(mins, F.lit("")).try_cast("long"), F.lit(0).cast("long")) * 60000
        + secs.try_cast("long") * 1000
        + frac.try_cast("long")
    )
    return F.when(s.isNotNull() & ok, ms).cast("long")


def format_lap_time(ms: Column | str) -> Column:
    """F2: 83456 -> ``'1:23.456'``."""
    m = F.col(ms) if isinstance(ms, str) else ms
    return F.format_string(
        "%d:%02d.%03d",
        F.floor(m / 60000).cast("long"),
        F.floor((m % 60000) / 1000).cast("long"),
        (m % 1000).cast("long"),
    )


def format_gap(ms: Column | str) -> Column:
    """F2: signed gap in seconds, ``+0.345s`` / ``-1.020s``."""
    m = F.col(ms) if isinstance(ms, str) else ms
    sign = F.when(m < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(m).cast("long")
    return F.concat(sign, F.format_string("%d.%03ds", F.floor(a / 1000).cast("long"), (a % 1000).cast("long")))
