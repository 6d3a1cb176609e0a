"""The declared data tests of the marts and sources, run on written tables.

All tests of a table are compiled into one aggregate over only the columns they name, so a
table is scanned once however many tests it has.  A key's ``unique`` and ``not_null`` come
from one count by key; every other test is a conditional count, a ``relationship`` after a
join with the parent's distinct keys.  Whole rows are looked at only for tests that fail.

``run_data_tests`` gives one row a test with its number of failing rows and one of
them as JSON; ``assert_data_tests`` raises with the failing tests and rows named.
The pipeline calls it after the marts.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.plans import quality as Q

#: Accepted timing-feed session types.
SESSION_TYPES = ["Race", "Qualifying", "Sprint", "Sprint Qualifying",
                 "Practice", "Practice 1", "Practice 2", "Practice 3"]


@dataclass(frozen=True)
class Test:
    """One check of one table: kind is not_null, unique, relationship or accepted."""

    __test__ = False  # not a pytest class

    table: str
    column: str
    kind: str
    parent: str = ""
    key: str = ""
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}"

    def failing(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "not_null":
            return Q.not_null(df, self.column)
        if self.kind == "unique":
            return Q.unique(df.filter(F.col(self.column).isNotNull()), [self.column])
        if self.kind == "relationship":
            return Q.relationships(df, self.column, tables[self.parent], self.key)
        return Q.accepted_values(df, self.column, list(self.values))


def _tests() -> list[Test]:
    keys = {"dim_drivers": "driver_id", "dim_circuits": "circuit_id", "dim_constructors": "constructor_id", "dim_sessions": "session_key"}
    required = {"fact_race_results": ["jolpica_driver_id", "constructor_id", "season", "round"], "fact_qualifying": ["driver_id"],
                "fact_sprint_results": ["driver_id"], "fact_laps": ["driver_id", "lap_number"],
                "lap_telemetry": ["session_key", "driver_number", "lap_number"], "qualifying_summary": ["driver_id", "season", "round"]}
    out = [Test(t, c, kind) for t, c in keys.items() for kind in ("not_null", "unique")]
    out += [Test(t, c, "not_null") for t, cols in required.items() for c in cols]
    out += [Test("fact_race_results", "jolpica_driver_id", "relationship", "dim_drivers", "driver_id"),
            Test("fact_race_results", "constructor_id", "relationship", "dim_constructors", "constructor_id"),
            Test("sessions", "session_type", "accepted", values=tuple(SESSION_TYPES))]
    return out


SUITE = _tests()


def _named(aggregated: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """One row of counts -> (test, n_failing) rows."""
    return aggregated.select(F.inline(F.array(*[
        F.struct(F.lit(t.name).alias("test"), F.coalesce(f"t{i}", F.lit(0)).cast("long").alias("n_failing")) for i, t in enumerate(tests)])))


def _key_tests(df: DataFrame, key: str, tests: Sequence[Test]) -> DataFrame:
    """``unique`` and ``not_null`` of one key, from one count by key."""
    sizes = df.select(F.col(key).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = {"unique": F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)), "not_null": F.sum(F.when(F.col("k").isNull(), F.col("n")))}
    return _named(sizes.agg(*[found[t.kind].alias(f"t{i}") for i, t in enumerate(tests)]), tests)


def _row_tests(df: DataFrame, tests: Sequence[Test], tables: dict[str, DataFrame]) -> DataFrame:
    """All other tests of a table, as conditional counts in one aggregate."""
    names = list(dict.fromkeys(t.column for t in tests))
    rows = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    counts = []
    for i, t in enumerate(tests):
        col = f"c{names.index(t.column)}"
        if t.kind == "relationship":
            keys = tables[t.parent].select(F.col(t.key).alias(col)).distinct().withColumn(f"held{i}", F.lit(True))
            rows = rows.join(keys, col, "left")
            count = F.count_if(F.col(col).isNotNull() & F.col(f"held{i}").isNull())
        elif t.kind == "accepted":  # each wrong value once; a null is one
            count = F.count_distinct(F.when(~F.col(col).isin(*t.values), F.col(col))) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
        else:
            count = F.count_if(F.col(col).isNull())
        counts.append(count.alias(f"t{i}"))
    return _named(rows.agg(*counts), tests)


def compile_tests(tables: dict[str, DataFrame], suite: Sequence[Test] = SUITE) -> DataFrame | None:
    """(test, n_failing) of all tests whose tables are there; a table's tests in one pass."""
    out = None
    for table in dict.fromkeys(t.table for t in suite):
        mine = [t for t in suite if t.table == table and t.table in tables and (not t.parent or t.parent in tables)]
        keys = list(dict.fromkeys(t.column for t in mine if t.kind == "unique"))
        of_key = [[t for t in mine if t.column == k and t.kind in ("unique", "not_null")] for k in keys]
        rest = [t for t in mine if t.kind != "unique" and not (t.kind == "not_null" and t.column in keys)]
        parts = [_key_tests(tables[table], k, ts) for k, ts in zip(keys, of_key, strict=True)]
        if rest:
            parts.append(_row_tests(tables[table], rest, tables))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out


def run_data_tests(spark: SparkSession, tables: dict[str, DataFrame], suite: Sequence[Test] = SUITE) -> DataFrame:
    """test, n_failing, example; tests of absent tables are left out.  The example is the
    smallest failing row in JSON form, looked up for failing tests alone."""
    compiled = compile_tests(tables, suite)
    counts = {} if compiled is None else {r["test"]: r["n_failing"] for r in compiled.collect()}  # a row a test
    rows = []
    for t in suite:
        if t.name in counts:
            n = counts[t.name]
            example = t.failing(tables).agg(F.min(F.to_json(F.struct("*")))).first()[0] if n else None
            rows.append((t.name, n, example))
    return spark.createDataFrame(rows, "test string, n_failing long, example string")


def assert_data_tests(spark: SparkSession, tables: dict[str, DataFrame], suite: Sequence[Test] = SUITE) -> int:
    """Raise if any test fails; returns the number of tests run."""
    results = run_data_tests(spark, tables, suite).collect()  # a row a test
    failed = [r for r in results if r["n_failing"]]
    if failed:
        raise ValueError("data tests failed: " + "; ".join(f"{r['test']}: {r['n_failing']} rows, e.g. {r['example']}" for r in failed))
    return len(results)
