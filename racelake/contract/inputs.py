"""Staging-shaped inputs built from the fixture adapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake import fixtures as fx


class Inputs:
    """Lazy accessors; each returns a DataFrame with staging column names."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    def _l(self, name: str) -> DataFrame:
        return fx.load(self.spark, self.sf, name)

    def races(self):
        return self._l("fx_races")

    def results(self):
        return self._l("fx_results_full").drop("driver_no")

    def sprint(self):
        return self._l("fx_sprint_results").drop("driver_no")

    def jlaps(self):
        return self._l("fx_stg_jolpica_laps")

    def quali(self):
        return self._l("fx_qualifying").select("season", "round", "driver_id", "constructor_id",
                                               "qualifying_position", "q1", "q2", "q3")

    def pit_stops(self):
        return self._l("fx_pit_stops")

    def driver_standings(self):
        return self._l("fx_driver_standings")

    def constructor_standings(self):
        return self._l("fx_constructor_standings")

    def drivers(self):
        return self._l("fx_stg_drivers")

    def constructors(self):
        return self._l("fx_stg_constructors")

    def circuits_raw(self):
        return self._l("fx_circuits")

    def circuit_stats(self):
        return self._l("fx_circuit_stats")

    def sessions(self):
        return self._l("fx_stg_sessions")

    def of1_drivers(self):
        return self._l("fx_timing_drivers")

    def of1_laps(self, segments: bool = False):
        laps = self._l("fx_stg_laps")
        if segments:
            # mini-sector codes derived from the lap number (fixed code set)
            code = lambda k: F.element_at(F.array(F.lit(2048), F.lit(2049), F.lit(2051), F.lit(2064)),
                                          ((F.col("lap_number") + k) % 4 + 1).cast("int"))
            laps = (laps.withColumn("segments_sector_1", F.array(code(0), code(1), code(2)))
                        .withColumn("segments_sector_2", F.array(code(1), code(3)))
                        .withColumn("segments_sector_3", F.array(code(2))))
        return laps

    def stints(self):
        return self._l("fx_stints")

    def driver_map(self):
        return self._l("fx_driver_id_map")

    # telemetry
    def car(self):
        return self._l("fx_car")

    def lap_starts(self):
        return self._l("fx_lap_starts")

    def location(self):
        return self._l("fx_location")

    def distance(self):
        return self._l("fx_distance")

    def sample_sessions(self):
        return self._l("fx_sample_sessions")

    def sample_races(self):
        return self._l("fx_sample_races")

    def sample_drivers(self):
        return self._l("fx_sample_drivers")

    def sample_driver_map(self):
        return self._l("fx_sample_driver_map")
