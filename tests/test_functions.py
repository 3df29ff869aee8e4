from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart import functions as fn


def test_local_timestamps_accept_every_source_pattern(spark):
    texts = [
        ("2024-01-01T05:30:11.123456", datetime(2024, 1, 1, 5, 30, 11, 123456)),
        ("2024-01-01T05:30:11", datetime(2024, 1, 1, 5, 30, 11)),
        ("2024-01-01T05:30", datetime(2024, 1, 1, 5, 30)),
        ("2024-01-01 05:30:11.5", datetime(2024, 1, 1, 5, 30, 11, 500000)),
        ("2024-01-01 05:30:11", datetime(2024, 1, 1, 5, 30, 11)),
        ("yesterday", None),
        (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in texts], "s string")
    got = df.select(fn.parse_local_ts(F.col("s")).cast("timestamp_ntz").alias("t")).collect()
    assert [r.t for r in got] == [want for _, want in texts]


def test_spring_forward_hour_merges_and_autumn_hour_repeats(spark):
    df = spark.createDataFrame(
        [("2024-03-10T01:00",), ("2024-03-10T02:00",), ("2024-03-10T03:00",),
         ("2024-11-03T01:00",), ("2024-11-03T01:00",)],
        "s string",
    )
    hours = df.select(fn.trunc_hour(fn.parse_local_ts(F.col("s"))).alias("h"))
    assert hours.distinct().count() == 3


def test_weather_codes(spark):
    df = spark.createDataFrame([(0,), (99,), (42,), (None,)], "c int")
    got = [r[0] for r in df.select(fn.weather_description(F.col("c"))).collect()]
    assert got == ["Clear sky", "Thunderstorm with heavy hail", "Unknown", None]


def test_payment_and_zone_labels(spark):
    df = spark.createDataFrame([(1, 132), (9, 48), (None, 200)], "p int, z int")
    rows = df.select(
        fn.payment_label(F.col("p")).alias("p"), fn.zone_display_name(F.col("z")).alias("z")
    ).collect()
    assert [r.p for r in rows] == ["Thẻ tín dụng", "Type 9", None]
    assert [r.z for r in rows] == ["JFK Airport", "Clinton East", "Zone 200"]


def test_core_zone_wins_over_airport(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1)], "a int, c int")
    got = [r[0] for r in df.select(fn.zone_type(F.col("a"), F.col("c"))).collect()]
    assert got == ["Bình thường", "Sân bay", "Manhattan core", "Manhattan core"]


def test_weekend_definitions_differ_by_model(spark):
    week = spark.range(7).select((F.col("id") + 1).alias("d"))
    flags = week.select(
        fn.is_weekend(F.col("d"), [6, 7]).alias("demand"),
        fn.is_weekend(F.col("d"), [5, 6]).alias("fare"),
    ).collect()
    assert [r.demand for r in flags] == [0, 0, 0, 0, 0, 1, 1]
    assert [r.fare for r in flags] == [0, 0, 0, 0, 1, 1, 0]


def test_flags_of_unknown_weather_are_zero(spark):
    df = spark.createDataFrame([(None, None)], "t double, p double")
    row = df.select(fn.is_cold(F.col("t")).alias("c"), fn.is_raining(F.col("p")).alias("r")).first()
    assert (row.c, row.r) == (0, 0)


def test_ratios_and_distance(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    got = [r[0] for r in df.select(fn.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.25, None, None]
    point = spark.range(1).select(
        fn.haversine_miles(F.lit(40.0), F.lit(-74.0), F.lit(41.0), F.lit(-74.0)).alias("d"),
        fn.haversine_miles(F.lit(40.0), F.lit(-74.0), F.lit(40.0), F.lit(-74.0)).alias("zero"),
    ).first()
    assert point.d == pytest.approx(69.0934, abs=1e-3)
    assert point.zero == 0


def test_round_even_is_array_library_rounding(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,)], "x double")
    got = [r[0] for r in df.select(fn.round_even(F.col("x"), 1)).collect()]
    assert got == [0.2, 0.4, 2.5]


def test_weighted_average_and_empty_input(spark):
    df = spark.createDataFrame([(10.0, 1), (20.0, 3)], "a double, n int")
    agg = fn.weighted_avg(F.col("a"), F.col("n")).alias("w")
    assert df.agg(agg).first().w == 17.5
    assert df.filter("n > 9").agg(agg).first().w is None
