"""Small lookup tables: constant updates and fixed-vocabulary maps."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Circuit length (km) and corner count applied to listed circuits.
# Each tuple: (circuit_id, length_km, corners).  Entries whose values must equal
# the source warehouse's published constants.
CIRCUIT_STATS = [
    ("bahrain", 5.412, 15), ("jeddah", 6.174, 27), ("albert_park", 5.278, 14),
    ("suzuka", 5.807, 18), ("shanghai", 5.451, 16), ("miami", 5.412, 19),
    ("imola", 4.909, 19), ("monaco", 3.337, 19), ("villeneuve", 4.361, 14),
    ("catalunya", 4.657, 16), ("red_bull_ring", 4.318, 10), ("silverstone", 5.891, 18),
    ("hungaroring", 4.381, 14), ("spa", 7.004, 19), ("zandvoort", 4.259, 14),
    ("monza", 5.793, 11), ("baku", 6.003, 20), ("marina_bay", 4.940, 23),
    ("americas", 5.513, 20), ("rodriguez", 4.304, 17), ("interlagos", 4.309, 15),
    ("vegas", 6.201, 17), ("las_vegas", 6.201, 17), ("losail", 5.380, 16),
    ("yas_marina", 5.281, 16),
]


def circuit_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CIRCUIT_STATS, "circuit_id string, length_km double, corners int")


def lookup_update(df: DataFrame, lookup: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``CASE key WHEN ... THEN new ELSE old END`` for the listed keys.

    The lookup is a fixed-size constant table (tens of rows), so it is
    broadcast; rows whose key is not listed keep their values.
    """
    lk = lookup.select(F.col(key), *[F.col(c).alias(f"__new_{c}") for c in cols])
    j = df.join(F.broadcast(lk), on=key, how="left")
    out = []
    for c in df.columns:
        out.append(F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c))
    return j.select(*out)


# Mini-sector segment codes and their colour labels.
SEGMENT_LABELS = [
    (2048, "yellow"), (2049, "green"), (2051, "purple"), (2064, "pit"), (0, "none"),
]


def segment_label_map():
    """``map(code -> label)`` literal for ``transform``/``element_at``."""
    args = []
    for code, label in SEGMENT_LABELS:
        args += [F.lit(code), F.lit(label)]
    return F.create_map(*args)
