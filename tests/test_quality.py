"""Data-quality checks return failing rows (pass = empty)."""

import datetime as dt

from racelake.plans import quality as Q


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "Race"), (1, "b", "Qualifying"), (2, None, "Warmup")],
                               "k int, fk string, t string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert Q.not_null(df, "fk").count() == 1
    assert [r.k for r in Q.unique(df, ["k"]).collect()] == [1]
    assert [r.fk for r in Q.relationships(df, "fk", parent, "pk").collect()] == ["b"]
    assert [r.t for r in Q.accepted_values(df, "t", ["Race", "Qualifying"]).collect()] == ["Warmup"]
    races = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2030, 1, 1),)], "race_date date")
    assert Q.no_future(races, "race_date", "2025-01-01").count() == 1
    assert Q.row_parity(df, df).count() == 0 and Q.row_parity(df, parent).count() == 1


def test_sample_rate(spark):
    t0 = dt.datetime(2024, 1, 1)
    fast = [(1, 1, t0 + dt.timedelta(milliseconds=270 * i)) for i in range(400)]      # ~3.7 Hz, passes
    slow = [(1, 2, t0 + dt.timedelta(seconds=2 * i)) for i in range(100)]             # 0.5 Hz, fails
    short = [(1, 3, t0 + dt.timedelta(seconds=i)) for i in range(30)]                  # < 60 s: not measured
    df = spark.createDataFrame(fast + slow + short, "session_key int, driver_number int, date timestamp")
    got = Q.sample_rate_outliers(df, ["session_key", "driver_number"], "date").collect()
    assert [r.driver_number for r in got] == [2]


def test_data_test_suite_names_the_failing_rows(spark):
    import pytest

    from racelake.plans import data_tests as DT
    good = {"dim_drivers": spark.createDataFrame([("a",), ("b",)], "driver_id string"),
            "dim_constructors": spark.createDataFrame([("x",)], "constructor_id string"),
            "fact_race_results": spark.createDataFrame([("a", "x", 2024, 1)], "jolpica_driver_id string, constructor_id string, season int, round int"),
            "sessions": spark.createDataFrame([("Race",)], "session_type string")}
    assert DT.assert_data_tests(spark, good) == 11
    bad = {**good, "dim_drivers": spark.createDataFrame([("a",), ("a",), (None,)], "driver_id string"),
           "fact_race_results": spark.createDataFrame([("q", "x", 2024, None)], good["fact_race_results"].schema)}
    with pytest.raises(ValueError) as e:
        DT.assert_data_tests(spark, bad)
    text = str(e.value)
    for part in ("not_null:dim_drivers.driver_id: 1 rows", "unique:dim_drivers.driver_id: 1 rows", '"driver_id":"a"',
                 "relationship:fact_race_results.jolpica_driver_id: 1 rows", '"jolpica_driver_id":"q"', "not_null:fact_race_results.round"):
        assert part in text
    assert DT.run_data_tests(spark, {}).count() == 0


def test_one_scan_a_table_and_the_same_results(spark, tmp_path):
    """However many tests a table has, it is read once; counts equal those of the checks."""
    from racelake.plans import data_tests as DT
    rows = [(i % 7 or None, i % 5, None if i % 3 else "c1") for i in range(40)]
    spark.createDataFrame(rows, "driver_id int, lap_number int, constructor_id string").write.parquet(f"{tmp_path}/laps")
    spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "driver_id int").write.parquet(f"{tmp_path}/drivers")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("laps", "drivers")}
    suite = [DT.Test("laps", "driver_id", "not_null"), DT.Test("laps", "constructor_id", "not_null"),
             DT.Test("laps", "lap_number", "accepted", values=(0, 1)), DT.Test("laps", "constructor_id", "accepted", values=("c1",)),
             DT.Test("drivers", "driver_id", "unique"), DT.Test("drivers", "driver_id", "not_null")]
    plan = DT.compile_tests(tables, suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    related = [*suite, DT.Test("laps", "driver_id", "relationship", "drivers", "driver_id")]
    got = {r.test: (r.n_failing, r.example) for r in DT.run_data_tests(spark, tables, related).collect()}
    assert {k: n for k, (n, _) in got.items()} == {t.name: t.failing(tables).count() for t in related}
    assert got["unique:drivers.driver_id"][1] == '{"driver_id":2,"n":2}'
