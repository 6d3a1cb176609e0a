"""racelake: motorsport warehouse jobs as plain Spark DataFrame plans.

Layers (each a set of ``DataFrame -> DataFrame`` functions):

* ``racelake.sources``    landing JSON pages -> typed raw tables (explicit schemas)
* ``racelake.plans.staging``  raw -> staging views
* ``racelake.operators``  generic operators (as-of join, interval slice,
  tolerance match, latest-version reads, change flag, incremental loads)
* ``racelake.plans.models``   dimensions, facts, marts, lap telemetry
* ``racelake.plans.reports``  parameterised report queries
* ``racelake.plans.quality``  data-quality checks (failing rows)
* ``racelake.plans.pipeline`` batch runs; ``racelake.streaming`` file streams
"""

from racelake.operators.asof import AsofRight, asof_join, asof_join_many
from racelake.operators.dedup import best_row, deterministic_any, latest_by_key, main_per_group, priority_lookup
from racelake.operators.incremental import after_watermark, unseen_keys
from racelake.operators.intervals import interval_bounds, slice_intervals
from racelake.operators.match import tolerance_match
from racelake.operators.windows import change_flag, delta_to_best, group_mean, ordinal, rows_at_group_min

__all__ = [
    "AsofRight", "asof_join", "asof_join_many", "best_row", "deterministic_any", "latest_by_key",
    "main_per_group", "priority_lookup", "after_watermark", "unseen_keys", "interval_bounds",
    "slice_intervals", "tolerance_match", "change_flag", "delta_to_best", "group_mean", "ordinal",
    "rows_at_group_min",
]
