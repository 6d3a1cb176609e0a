"""Checked casts, JSON path reads and timestamp parsing (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_null(c: Column | str, type_: str) -> Column:
    """F4 ``toXOrNull``: NULL when the text does not parse."""
    return _c(c).cast("string").try_cast(type_)


def or_zero(c: Column | str, type_: str) -> Column:
    """F4 ``toXOrZero``."""
    return F.coalesce(or_null(c, type_), F.lit(0).cast(type_))


def json_field(json_col: Column | str, field: str, type_: str) -> Column:
    """A scalar JSON field as ``type_``; missing, empty or unparsable
    values are NULL (numbers given as JSON numbers are accepted too)."""
    raw = F.get_json_object(_c(json_col), f"$.{field}")
    return F.nullif(raw, F.lit("")).try_cast(type_)


def with_json_fallback(col: Column | str, json_col: Column | str, field: str, type_: str) -> Column:
    """the typed column when set, else the value kept in the raw JSON."""
    return F.coalesce(_c(col).cast(type_), json_field(json_col, field, type_))


def parse_ts(c: Column | str, unit: str = "MILLISECOND") -> Column:
    """F8: best-effort ISO-8601 parse (``Z`` / offsets accepted) -> UTC
    timestamp truncated to ``unit``; bad text -> NULL."""
    return F.date_trunc(unit, F.try_to_timestamp(_c(c)))


def hex_colour(c: Column | str) -> Column:
    """``'3671C6'`` -> ``'#3671C6'``; NULL or empty -> NULL."""
    return F.concat(F.lit("#"), F.nullif(_c(c), F.lit("")))
