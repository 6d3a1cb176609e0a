"""Contract queries: one Spark DataFrame builder per surveyed operator, plus
the DuckDB SQL that must return the same rows (the correctness oracle)."""

from racelake.contract.registry import ORACLE, QUERIES  # noqa: F401
from racelake.contract import q_models, q_reports, q_ops, q_sources, q_quality, q_loads  # noqa: F401,E402
