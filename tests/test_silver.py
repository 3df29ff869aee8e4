import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart.operators import silver

BRONZE = (
    "topic string, partition int, offset bigint, kafka_timestamp timestamp, json_data string, "
    "taxi_type string"
)
T0 = datetime(2024, 1, 5, 8, 0)


def trip(**changes):
    record = {
        "VendorID": 1,
        "tpep_pickup_datetime": "2024-01-05T08:10:00",
        "tpep_dropoff_datetime": "2024-01-05T08:20:00",
        "passenger_count": 1.0,
        "trip_distance": 2.5,
        "RatecodeID": 1.0,
        "PULocationID": 132,
        "DOLocationID": 161,
        "payment_type": 1.0,
        "fare_amount": 12.5,
        "total_amount": 15.0,
        "_source_file": "yellow.parquet",
    }
    record.update(changes)
    return json.dumps(record)


def bronze(spark, *rows):
    """rows: (offset, minutes after T0, json)"""
    data = [
        ("t", 0, offset, T0 + timedelta(minutes=late), text, "yellow")
        for offset, late, text in rows
    ]
    return spark.createDataFrame(data, BRONZE)


def test_yellow_green_and_mixed_payloads(spark):
    green = trip(lpep_pickup_datetime="2024-01-05 09:00:00", trip_type=2.0, ehail_fee=1.0)
    df = bronze(spark, (1, 0, trip(airport_fee=1.75)), (2, 0, green))
    yellow = silver.parse_trips(df, "yellow").orderBy("offset").collect()
    assert yellow[0].airport_fee == 1.75 and yellow[1].trip_type is None
    assert yellow[0].taxi_type == "yellow" and yellow[1].ehail_fee is None
    as_green = silver.parse_trips(df, "green").orderBy("offset").collect()
    assert as_green[1].pickup_datetime_raw == "2024-01-05 09:00:00"
    assert as_green[1].trip_type == 2 and as_green[0].airport_fee is None
    mixed = silver.parse_trips(df, "auto").orderBy("offset").collect()
    assert mixed[0].pickup_datetime_raw == "2024-01-05T08:10:00"


def test_payload_type_beats_column_and_path_tag(spark):
    df = bronze(spark, (1, 0, trip(_taxi_type="green")), (2, 0, trip()))
    got = silver.parse_trips(df.withColumn("taxi_type_from_path", F.lit("x")))
    assert [r.taxi_type for r in got.orderBy("offset").collect()] == ["green", "yellow"]


def test_absent_envelope_columns_become_typed_nulls(spark):
    df = spark.createDataFrame([(trip(),)], "json_data string")
    full = silver.ensure_envelope(df)
    types = dict(full.dtypes)
    assert types["offset"] == "bigint" and types["kafka_timestamp"] == "timestamp"
    assert "void" not in types.values()


def test_rows_without_offset_are_not_copies_of_each_other(spark):
    rows = [trip(PULocationID=z) for z in (1, 2, 3)]
    df = spark.createDataFrame([(r,) for r in rows], "json_data string")
    trips = silver.normalize_trips(silver.parse_trips(df, "yellow"))
    assert trips.count() == 3


def test_row_filters(spark):
    df = bronze(
        spark,
        (1, 0, trip()),
        (2, 0, '{"VendorID": '),
        (3, 0, trip(tpep_pickup_datetime="not a time")),
        (4, 0, trip(PULocationID=None)),
        (5, 0, trip(tpep_pickup_datetime="2022-12-31T23:59:59")),
        (6, 0, trip(tpep_pickup_datetime="2025-01-01T00:00:00", tpep_dropoff_datetime=None)),
        (7, 0, trip(tpep_dropoff_datetime="2024-01-05T08:09:59")),
        (8, 0, trip(tpep_dropoff_datetime=None, fare_amount=99.0)),
    )
    kept = silver.normalize_trips(silver.parse_trips(df, "yellow"))
    assert sorted(r.offset for r in kept.collect()) == [1, 8]


def test_transport_copies_keep_the_first_arrival(spark):
    df = bronze(
        spark,
        (1, 30, trip(passenger_count=3.0)),
        (1, 0, trip(passenger_count=1.0)),
        (1, 60, trip(passenger_count=5.0)),
    )
    trips = silver.normalize_trips(silver.parse_trips(df, "yellow")).collect()
    assert [r.passenger_count for r in trips] == [1.0]


def test_business_copies_keep_the_first_arrival_whatever_the_partitioning(spark):
    df = bronze(
        spark,
        *[(n, 60 - n, trip(passenger_count=float(n), trip_distance=None)) for n in range(1, 40)],
    )
    results = set()
    for parts in (1, 3, 7):
        got = silver.normalize_trips(silver.parse_trips(df.repartition(parts), "yellow")).collect()
        assert len(got) == 1
        results.add(got[0].offset)
    assert results == {39}


def test_deduplication_is_idempotent_and_limits_groups_before_the_shuffle(spark, plan_of):
    df = bronze(spark, (1, 0, trip()), (2, 5, trip()), (3, 0, trip(PULocationID=7)))
    once = silver.normalize_trips(silver.parse_trips(df, "yellow"))
    assert silver.dedup_business(silver.dedup_transport(once)).count() == once.count() == 2
    plan = plan_of(silver.dedup_business(once))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_business_key_shuffles_one_row_per_task(spark):
    hot = spark.range(20_000, numPartitions=8).select(
        F.lit("k").alias("key"), F.col("id").alias("kafka_timestamp"), (F.col("id") % 7).alias("v")
    )
    kept = silver.keep_first(hot, ["key"])
    assert kept.collect()[0].kafka_timestamp == 0
    assert kept.count() == 1


def test_payload_is_parsed_once(spark, plan_of):
    df = bronze(spark, (1, 0, trip()))
    plan = plan_of(silver.normalize_trips(silver.parse_trips(df, "yellow"), dedup=False))
    assert plan.count("from_json(") == 1


WEATHER = "topic string, partition int, offset bigint, kafka_timestamp timestamp, json_data string"


def reading(spark, *rows):
    data = [
        ("w", 0, n, T0 + timedelta(minutes=late), json.dumps(record))
        for n, (late, record) in enumerate(rows)
    ]
    return silver.normalize_weather(silver.parse_weather(spark.createDataFrame(data, WEATHER)))


def test_hourly_weather_takes_first_known_value_per_column(spark):
    rows = reading(
        spark,
        (9, {"timestamp": "2024-01-05T08:40", "temperature_f": 40.0, "precipitation_mm": 1.0}),
        (0, {"timestamp": "2024-01-05T08:00", "temperature_f": None, "precipitation_mm": 0.0}),
        (5, {"timestamp": "2024-01-05T08:20", "temperature_f": 35.0}),
        (5, {"timestamp": "2024-01-05T09:00"}),
        (5, {"timestamp": "broken"}),
    )
    hours = silver.hourly_weather(rows).orderBy("weather_hour").collect()
    assert len(hours) == 2
    assert (hours[0].temperature_f, hours[0].precipitation_mm) == (35.0, 0.0)
    assert hours[1].temperature_f is None
    first = silver.hourly_weather(rows, "first_row").orderBy("weather_hour").collect()
    assert first[0].temperature_f is None and first[0].precipitation_mm == 0.0
    with pytest.raises(ValueError):
        silver.hourly_weather(rows, "last")


def test_weather_join_keeps_every_trip_once(spark, plan_of):
    trips = silver.normalize_trips(
        silver.parse_trips(
            bronze(
                spark,
                (1, 0, trip()),
                (2, 0, trip(tpep_pickup_datetime="2024-01-05T03:00:00")),
            ),
            "yellow",
        )
    )
    weather = silver.hourly_weather(
        reading(spark, (0, {"timestamp": "2024-01-05T08:00", "temperature_f": 33.0}))
    )
    hours = silver.window_hours("2023-01-01", "2025-01-01")
    assert hours == 731 * 24 + 1
    joined = silver.join_weather(trips, weather, window=("2023-01-01", "2025-01-01"))
    got = {r.offset: r.temperature_f for r in joined.collect()}
    assert got == {1: 33.0, 2: None}
    assert "BroadcastHashJoin" in plan_of(joined)


def test_unproven_dimension_is_left_to_the_optimizer(spark, plan_of):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(10).withColumnRenamed("id", "k")
    from tripmart.operators.joins import BROADCAST_ROW_BOUND, lookup_join

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup_join(left, right, "k", proven_rows=BROADCAST_ROW_BOUND + 1)
        assert "SortMergeJoin" in plan_of(big)
        assert "BroadcastHashJoin" in plan_of(lookup_join(left, right, "k", proven_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
