"""Scalar functions: lap-time parse/format (N7, N8), casts, JSON fallback (N18), timestamps (F8)."""

import pytest
from pyspark.sql import functions as F

from racelake.functions.casts import hex_colour, json_field, or_null, or_zero, parse_ts, with_json_fallback
from racelake.functions.laptime import format_gap, format_lap_time, parse_lap_time

CASES = [
    ("1:23.456", 83456), ("83.456", 83456), ("0:59.999", 59999), ("1:23.4", 83400), ("22.5", 22500),
    ("17:03.456", 1023456), ("1:02:03.456", None), ("", None), (None, None), ("abc", None), ("1:2x.3", None),
    (" 1:23.456 ", 83456),
]


@pytest.mark.parametrize("text,ms", CASES)
def test_parse_lap_time(spark, text, ms):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_lap_time("t").alias("ms")).first().ms == ms


def test_format_round_trip(spark):
    df = spark.createDataFrame([(83456,), (59999,), (600001,), (5,)], "ms long")
    got = [r.s for r in df.select(format_lap_time("ms").alias("s")).collect()]
    assert got == ["1:23.456", "0:59.999", "10:00.001", "0:00.005"]
    back = df.select(parse_lap_time(format_lap_time("ms")).alias("b"), "ms").collect()
    assert all(r.b == r.ms for r in back)
    gaps = spark.createDataFrame([(345,), (-1020,), (0,)], "g long").select(format_gap("g").alias("s"))
    assert [r.s for r in gaps.collect()] == ["+0.345s", "-1.020s", "+0.000s"]


def test_checked_casts_under_ansi(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,)], "s string")
    got = df.select(or_null("s", "int").alias("a"), or_zero("s", "int").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(12, 12), (None, 0), (None, 0), (None, 0)]


def test_json_fallback(spark):
    df = spark.createDataFrame([(None, '{"length": "5.412", "turns": ""}'), (4.0, '{"length": "9"}'),
                                (None, '{"length": 3.3}'), (None, "not json")], "col double, j string")
    got = df.select(with_json_fallback("col", "j", "length", "double").alias("v"),
                    json_field("j", "turns", "int").alias("t")).collect()
    assert [r.v for r in got] == [5.412, 4.0, 3.3, None]
    assert [r.t for r in got] == [None, None, None, None]


def test_timestamp_parse_and_truncate(spark):
    df = spark.createDataFrame([("2024-03-02T14:00:00.123456+00:00",), ("2024-03-02T14:00:00.999Z",),
                                ("2024-03-02T16:00:00.5+02:00",), ("garbage",)], "s string")
    got = df.select(F.date_format(parse_ts("s"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("v")).collect()
    assert [r.v for r in got] == ["2024-03-02 14:00:00.123000", "2024-03-02 14:00:00.999000",
                                  "2024-03-02 14:00:00.500000", None]


def test_hex_colour(spark):
    df = spark.createDataFrame([("3671C6",), ("",), (None,)], "c string")
    assert [r.v for r in df.select(hex_colour("c").alias("v")).collect()] == ["#3671C6", None, None]
