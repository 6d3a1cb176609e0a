"""Driver-number bridge (season, results-feed driver id) -> car number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.operators.dedup import latest_by_key


def driver_number_bridge(result_numbers: DataFrame, drivers: DataFrame) -> DataFrame:
    """Race-result numbers first (the number a driver actually raced with;
    for a number used by several drivers in a season the last race wins),
    then permanent numbers only for numbers not taken that way; finally one
    row per (season, driver), the one from the latest race.

    ``result_numbers``: season, round, driver_id, number.
    ``drivers``: season, driver_id, permanent_number.
    """
    raced = (result_numbers.filter(F.col("number").isNotNull())
             .groupBy("season", F.col("number").alias("openf1_driver_number"))
             .agg(F.max_by(F.struct("driver_id", "round"), F.struct("round", "driver_id")).alias("m"))
             .select("season", "openf1_driver_number", F.col("m.driver_id").alias("jolpica_driver_id"),
                     F.col("m.round").alias("__rank")))
    perm = (drivers.filter(F.col("permanent_number").isNotNull())
            .select("season", F.col("permanent_number").alias("openf1_driver_number"),
                    F.col("driver_id").alias("jolpica_driver_id"), F.lit(-1).alias("__rank")))
    fill = perm.join(raced.select("season", "openf1_driver_number"), ["season", "openf1_driver_number"], "left_anti")
    # a free permanent number claimed by several drivers goes to the first one listed
    # (the feed lists drivers in order of their ids)
    fill = (fill.groupBy("season", "openf1_driver_number").agg(F.min("jolpica_driver_id").alias("jolpica_driver_id"))
            .withColumn("__rank", F.lit(-1)))
    both = raced.unionByName(fill)
    return (latest_by_key(both, ["season", "jolpica_driver_id"], "__rank", ["openf1_driver_number"])
            .select("jolpica_driver_id", "openf1_driver_number", "season"))
