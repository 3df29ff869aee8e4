from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart import constants as K
from tripmart.operators import core as core_ops
from tripmart.operators import gold, marts
from tripmart.operators.quantiles import exact_quantile

TS = datetime(2024, 1, 6, 8, 15)


def trips(spark, rows):
    """rows: dicts of changed columns"""
    base = {
        "taxi_type": "yellow", "vendor_id": 1, "pickup_datetime": TS,
        "dropoff_datetime": datetime(2024, 1, 6, 8, 30), "pickup_hour": datetime(2024, 1, 6, 8),
        "pickup_date": TS.date(), "pickup_year_month": "2024-01", "pu_location_id": 132,
        "do_location_id": 161, "passenger_count": 1.0, "trip_distance": 3.0, "ratecode_id": 1,
        "payment_type": 1, "fare_amount": 10.0, "extra": 0.5, "mta_tax": 0.5, "tip_amount": 2.0,
        "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 14.0,
        "congestion_surcharge": 2.5, "airport_fee": 1.75, "temperature_f": 34.0,
        "humidity_percent": 50.0, "precipitation_mm": 0.0, "weather_code": 3,
        "wind_speed_kmh": 5.0, "wind_direction_deg": 90.0, "cloud_cover_percent": 10.0,
    }
    schema = (
        "taxi_type string, vendor_id bigint, pickup_datetime timestamp, "
        "dropoff_datetime timestamp, pickup_hour timestamp, pickup_date date, "
        "pickup_year_month string, pu_location_id int, do_location_id int, "
        "passenger_count double, trip_distance double, ratecode_id int, payment_type int, "
        "fare_amount double, extra double, mta_tax double, tip_amount double, "
        "tolls_amount double, improvement_surcharge double, total_amount double, "
        "congestion_surcharge double, airport_fee double, temperature_f double, "
        "humidity_percent double, precipitation_mm double, weather_code int, "
        "wind_speed_kmh double, wind_direction_deg double, cloud_cover_percent double"
    )
    data = [tuple({**base, **r}[c] for c in base) for r in rows]
    return spark.createDataFrame(data, schema)


def test_core_matches_its_contract(spark):
    core = core_ops.build_core(trips(spark, [{}]))
    assert dict(core.dtypes) == K.CORE_CONTRACT


def test_validity_limits_and_three_valued_outlier_flag(spark):
    cases = [
        ({"fare_amount": None}, (True, False, True, None)),
        ({"total_amount": None}, (True, True, False, None)),
        ({"trip_distance": 0.0}, (False, True, True, True)),
        ({"trip_distance": 100.0}, (True, True, True, False)),
        ({"trip_distance": 100.01}, (False, True, True, True)),
        ({"fare_amount": 1000.0}, (True, True, True, False)),
        ({"fare_amount": 1000.01, "total_amount": None}, (True, False, False, True)),
        ({"total_amount": 1500.0}, (True, True, True, False)),
        ({"total_amount": 1500.01}, (True, True, False, True)),
        ({"fare_amount": -0.01}, (True, False, True, True)),
    ]
    core = core_ops.build_core(trips(spark, [{**c, "vendor_id": i} for i, (c, _) in enumerate(cases)]))
    rows = core.orderBy("vendor_id").collect()
    for row, (_, want) in zip(rows, cases, strict=True):
        got = (row.is_valid_distance, row.is_valid_fare, row.is_valid_total_amount,
               row.is_outlier_trip)
        assert got == want
    kept = gold.candidates(core)
    assert sorted(r.vendor_id for r in kept.collect()) == [3, 5, 7]


def test_values_beyond_the_narrow_type_become_null_and_money_rounds_half_up(spark):
    core = core_ops.build_core(
        trips(spark, [{"vendor_id": 300, "pu_location_id": 70_000, "fare_amount": 2.345}])
    ).first()
    assert core.vendor_id is None and core.pu_location_id is None
    assert core.fare_amount == Decimal("2.35")


def test_clean_imputes_and_flags(spark):
    core = core_ops.build_core(
        trips(
            spark,
            [
                {"vendor_id": 1, "passenger_count": None, "ratecode_id": None,
                 "payment_type": None, "congestion_surcharge": None, "airport_fee": None},
                {"vendor_id": 2},
                {"vendor_id": 3, "temperature_f": None},
            ],
        )
    )
    rows = core_ops.build_clean(core).orderBy("vendor_id").collect()
    assert len(rows) == 2
    filled, kept = rows
    assert (filled.passenger_count_clean, filled.ratecode_id_clean) == (1, 99)
    assert (filled.payment_type_clean, filled.airport_fee_clean) == (0, Decimal("0.00"))
    assert filled.is_airport_fee_missing and not kept.is_airport_fee_missing
    assert kept.airport_fee_clean == Decimal("1.75") and kept.is_gold_candidate


def test_demand_counts_per_zone_and_hour(spark):
    core = core_ops.build_core(
        trips(spark, [{}, {}, {"pu_location_id": 1}, {"temperature_f": None}, {"fare_amount": None}])
    )
    demand = gold.demand_features(core)
    assert dict(demand.dtypes) == K.DEMAND_CONTRACT
    rows = {r.pu_location_id: r for r in demand.collect()}
    assert rows[132].demand == 3 and rows[1].demand == 1
    assert rows[132].temperature_f == 34.0
    assert (rows[1].hour, rows[1].day_of_week, rows[1].month) == (8, 7, 1)


def test_fare_tip_policy(spark):
    cases = [
        ({}, True),
        ({"fare_amount": 2.5, "tip_amount": 0.0}, True),
        ({"fare_amount": 2.49}, False),
        ({"fare_amount": 300.0}, True),
        ({"fare_amount": 300.01}, False),
        ({"tip_amount": -1.0}, False),
        ({"fare_amount": 10.0, "tip_amount": 10.0}, True),
        ({"fare_amount": 10.0, "tip_amount": 10.01}, False),
        ({"fare_amount": 0.0, "tip_amount": 0.0}, False),
        ({"passenger_count": None, "payment_type": None}, True),
    ]
    core = core_ops.build_core(trips(spark, [{**c, "do_location_id": i} for i, (c, _) in enumerate(cases)]))
    features = gold.fare_tip_features(core)
    assert dict(features.dtypes) == K.FARE_TIP_CONTRACT
    kept = sorted(r.do_location_id for r in features.collect())
    assert kept == [i for i, (_, ok) in enumerate(cases) if ok]
    wide = gold.fare_tip_features(core, max_fare=500.0)
    assert wide.count() == len(kept) + 1


def demand_rows(spark):
    done = datetime(2025, 1, 1)
    return spark.createDataFrame(
        [
            ("2024-01", 1, 10, datetime(2024, 1, 1), 30.0, 0.0, done),
            ("2024-01", 1, 20, datetime(2024, 1, 2), 32.0, 1.0, done),
            ("2024-01", 2, 5, datetime(2024, 1, 1), 31.0, 0.0, done),
            ("2024-02", 1, 7, datetime(2024, 2, 1), 35.0, 0.0, done),
        ],
        "pickup_year_month string, pu_location_id bigint, demand bigint, pickup_hour timestamp, "
        "temperature_f double, precipitation_mm double, gold_processed_timestamp timestamp",
    )


def zone_rows(spark):
    return spark.createDataFrame(
        [(1, "EWR", "Newark Airport", 40.69, -74.17), (2, "Queens", "Jamaica Bay", 40.61, -73.84)],
        "location_id int, borough string, zone string, latitude double, longitude double",
    )


def test_zone_summary_grain_and_total(spark):
    demand = demand_rows(spark)
    summary = marts.zone_summary(demand, marts.pickup_zones(zone_rows(spark)))
    keys = {(r.pickup_year_month, r.pu_location_id) for r in summary.collect()}
    assert keys == {("2024-01", 1), ("2024-01", 2), ("2024-02", 1)}
    assert summary.count() == len(keys)
    assert summary.agg(F.sum("total_demand")).first()[0] == 42


def test_hourly_kpi_counts_zones_either_way(spark):
    demand = demand_rows(spark).withColumns(
        {"hour": F.hour("pickup_hour"), "day_of_week": F.dayofweek("pickup_hour"),
         "month": F.month("pickup_hour")}
    )
    drop = "dashboard_processed_timestamp"
    distinct = marts.hourly_kpi(demand).drop(drop)
    counted = marts.hourly_kpi(demand, unique_key=True).drop(drop)
    assert distinct.exceptAll(counted).count() == 0 and counted.count() == distinct.count() == 3
    assert {r.active_zones for r in distinct.collect()} == {1, 2}


def test_unknown_payment_type_is_its_own_group_and_medians_agree(spark):
    rng = np.random.default_rng(7)
    rows = [
        (None if n % 4 == 0 else int(n % 3) + 1, Decimal(int(f)) / 100, float(np.float32(t)))
        for n, (f, t) in enumerate(
            zip(rng.integers(250, 30_000, 301), rng.uniform(0, 100, 301), strict=True)
        )
    ]
    fare_tip = spark.createDataFrame(
        rows, "payment_type int, fare_amount decimal(12,2), tip_percent float"
    ).withColumns(
        {"pickup_year_month": F.lit("2024-01"), "month": F.lit(1), "tip_amount": F.lit(1.0),
         "trip_distance": F.lit(1.0), "gold_processed_timestamp": F.lit(TS)}
    )
    approx = {r.payment_type: r for r in marts.payment_tip_summary(fare_tip).collect()}
    exact = {
        r.payment_type: r
        for r in marts.payment_tip_summary(fare_tip, exact_median=True).collect()
    }
    assert set(approx) == {None, 1, 2, 3}
    for kind, row in exact.items():
        fares = sorted(f for k, f, _ in rows if k == kind)
        tips = sorted(t for k, _, t in rows if k == kind)
        middle = -(-len(fares) // 2) - 1
        assert row.median_fare_amount == fares[middle] == approx[kind].median_fare_amount
        assert row.median_tip_percent == pytest.approx(tips[middle])
        assert row.trip_count == len(fares)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.99, 1.0])
def test_exact_quantile_against_sorting(spark, fraction):
    rng = np.random.default_rng(3)
    data = [("hot" if n % 3 else f"k{n % 5}", float(v)) for n, v in
            enumerate(rng.integers(0, 50, 400))]
    df = spark.createDataFrame(data + [("hot", None)], "k string, v double")
    got = {r.k: r.quantile for r in
           exact_quantile(df, ["k"], "v", fraction, bucket=F.floor(F.col("v") / 7)).collect()}
    for key in {k for k, _ in data}:
        values = sorted(v for k, v in data if k == key)
        rank = max(int(np.ceil(len(values) * fraction)), 1)
        assert got[key] == values[rank - 1]


def test_refresh_zone_names(spark):
    mart = marts.zone_summary(demand_rows(spark), marts.pickup_zones(zone_rows(spark)))
    lookup = spark.createDataFrame([(1, None, "Renamed")], "location_id int, borough string, zone string")
    rows = {(r.pickup_year_month, r.pu_location_id): r
            for r in marts.refresh_zone_names(mart, lookup).collect()}
    assert rows[("2024-01", 1)].pickup_zone == "Renamed"
    assert rows[("2024-01", 1)].pickup_borough is None
    assert rows[("2024-01", 2)].pickup_zone == "Jamaica Bay"
