"""Global rank against a sort, with ties, nulls, hot values and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from racelake.operators.rank import global_rank


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_rank_is_the_place_in_the_sort(spark, partitions):
    rnd = random.Random(partitions)
    rows = [(rnd.choice([None, 7, 7, 7, rnd.randrange(50)]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, place long").repartition(6)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = global_rank(df, [F.desc_nulls_last("v"), F.asc("place")], "rank").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["v"], r["place"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))


def test_equal_rows_get_successive_ranks(spark):
    df = spark.range(100).select(F.lit(1).alias("part"), F.lit(2).alias("row"), F.lit(3).alias("Offset"))
    got = global_rank(df, ["part"], "rank")
    assert got.columns == ["part", "row", "Offset", "rank"]
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 101))


def test_no_rows_and_taken_name(spark):
    empty = spark.range(0)
    assert global_rank(empty, ["id"], "rank").count() == 0
    with pytest.raises(ValueError):
        global_rank(spark.range(1).withColumnRenamed("id", "Rank"), ["Rank"], "rank")


def test_only_partition_counts_meet_in_one_task(spark):
    plan = global_rank(spark.range(1000), ["id"], "rank")._jdf.queryExecution().executedPlan().toString()
    # the one window without a key stands above the counts, not above the rows
    assert plan.count("Window [") <= 1 and "HashAggregate" in plan
