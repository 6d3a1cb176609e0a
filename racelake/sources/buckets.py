"""Telemetry feeds laid out for as-of joins without a shuffle.

A feed is written as a table bucketed by (session_key, driver_number) and sorted by time
inside each bucket.  Feeds with one bucket count are partitioned alike, so their union
keeps that partitioning: de-duplication, the as-of joins and the change flag of
``models.lap_telemetry`` all run bucket by bucket, with no exchange above the scans.

Each load appends one file a bucket; ``compact`` folds the loads of a feed into one file a
bucket again, one row a sample.  Rows without a key or time can match nothing and are left
out when a feed is written.  A bucket is one task: a (session,
driver) too long for that belongs to ``HotKeys``, which cuts keys by time.

Spark keeps bucket counts in its catalog alone, so ``read_buckets`` declares the files as
an external table under a name of its own.  The count must be the one they were written with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["session_key", "driver_number"]
TIME = "date"


def write_buckets(feed: DataFrame, path: str, buckets: int) -> None:
    """Append a load of a feed (session_key, driver_number, date, ...) to its table."""
    whole = feed.filter(F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull() & F.col(TIME).isNotNull())
    whole = whole.withColumns({k: F.col(k).cast("long") for k in KEYS})
    name = _declare(feed.sparkSession, path, whole.schema, buckets)
    # dealt the way buckets are: each task holds one bucket and writes one file
    whole.repartition(buckets, *KEYS).select(*whole.columns).write.insertInto(name)


def _renewed(df: DataFrame) -> list:
    """The columns under new names of the planner's own: it compares the partitionings of
    a union's inputs by column, and takes columns that still belong to a named table for
    different ones."""
    return [F.col(c).alias(c) for c in df.columns]


def read_buckets(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A feed as it was written, bucketed for the planner."""
    table = spark.table(_declare(spark, path, spark.read.parquet(path).schema, buckets))
    return table.select(*_renewed(table))


def in_buckets(small: DataFrame, buckets: int) -> DataFrame:
    """A small input (lap bounds) dealt like the feeds, so that it can join their union."""
    dealt = small.withColumns({k: F.col(k).cast("long") for k in KEYS})
    return dealt.select(*_renewed(dealt)).repartition(buckets, *KEYS)


def compact(spark: SparkSession, path: str, to: str, buckets: int) -> None:
    """Write a feed anew under ``to``: one file a bucket, the latest row of each sample."""
    from racelake.plans.staging import one_per_sample
    write_buckets(one_per_sample(read_buckets(spark, path, buckets)), to, buckets)


def _declare(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> str:
    name = f"feed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) "
              f"SORTED BY ({', '.join([*KEYS, TIME])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name
