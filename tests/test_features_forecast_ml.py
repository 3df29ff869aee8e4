from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart import constants as K
from tripmart.operators import features, forecast, geo, ml, ordering
from tripmart.plans.batch import Layout, run_score

T0 = datetime(2024, 1, 1)


def series(spark, hours, zone=1):
    rows = [(zone, T0 + timedelta(hours=h), h + 1) for h in hours]
    return spark.createDataFrame(
        rows, "pu_location_id smallint, pickup_hour timestamp, demand int"
    )


def test_row_lags_count_rows_and_time_lags_count_hours(spark):
    demand = series(spark, [0, 1, 2, 24, 26, 48, 72, 168])
    row = {r.demand: r for r in features.lags(demand, (1, 2, 24, 48)).collect()}
    assert (row[25].demand_lag1h, row[25].demand_lag2h) == (3, 2)
    assert row[169].demand_lag24h is None
    time = {r.demand: r for r in features.lags(demand, (1, 2, 24, 48), "time").collect()}
    assert time[25].demand_lag1h is None and time[25].demand_lag24h == 1
    assert time[27].demand_lag24h == 3 and time[27].demand_lag2h == 25
    assert time[49].demand_lag48h == 1 and time[73].demand_lag24h == 49
    with pytest.raises(ValueError):
        features.lags(demand, (1,), "calendar")


def full(demand):
    ts = F.col("pickup_hour")
    return demand.withColumns(
        {
            "hour": F.hour(ts).cast("tinyint"),
            "day_of_week": F.dayofweek(ts).cast("tinyint"),
            "month": F.month(ts).cast("tinyint"),
            "temperature_f": (F.lit(30) + F.hour(ts)).cast("float"),
            "precipitation_mm": F.when(F.hour(ts) % 5 == 0, 1.0).otherwise(0.0).cast("float"),
            "pickup_year_month": F.date_format(ts, "yyyy-MM"),
        }
    )


def test_demand_features_need_a_week_of_history(spark):
    built = features.demand_features(full(series(spark, range(200), zone=132)))
    assert built.count() == 200 - 168
    assert set(K.DEMAND_FEATURES) <= set(built.columns)
    row = built.orderBy("pickup_hour").first()
    assert row.demand_lag168h == 1 and row.demand_vmo_3day == pytest.approx((145 + 121 + 97) / 3)
    assert row.is_airport == 1 and row.is_manhattan_core == 0
    holiday = features.demand_features(full(series(spark, range(3))), complete_only=False).first()
    assert holiday.is_holiday == 1 and holiday.is_cold == 1 and holiday.is_raining == 1


def test_fare_and_tip_rows(spark):
    df = spark.createDataFrame(
        [(10.0, 1.0, None, None, 1, 20.0), (500.0, 1.0, 1, 1, 1, 5.0), (20.0, 150.0, 1, 1, 1, 5.0),
         (20.0, 3.0, 2, 2, 2, 0.0), (20.0, 3.0, 2, 2, 1, 100.5), (20.0, 3.0, 2, 2, None, 5.0)],
        "fare_amount double, trip_distance double, passenger_count smallint, ratecode_id tinyint, "
        "payment_type tinyint, tip_percent float",
    ).withColumns({"day_of_week": F.lit(5), "hour": F.lit(8), "precipitation_mm": F.lit(0.0),
                   "temperature_f": F.lit(35.9)})
    fares = features.fare_features(df)
    assert fares.count() == 4
    first = fares.first()
    assert (first.passenger_count, first.ratecode_id) == (1, 1)
    assert (first.is_weekend, first.is_rush_hour, first.is_raining, first.is_cold) == (1, 1, 0, 1)
    assert features.tip_features(fares).count() == 1


def test_hash_sample_is_stable_and_skips_unknown_keys(spark):
    df = spark.range(2000).select(
        (F.col("id") % 250).alias("pu_location_id"), (F.col("id") % 24).alias("hour"),
        F.when(F.col("id") % 10 > 0, F.col("id") / 7).alias("trip_distance"))
    once = features.hash_sample(df, 20)
    again = features.hash_sample(df.repartition(5), 20)
    assert once.exceptAll(again).count() == 0 and once.count() == again.count()
    assert 200 < once.count() < 520
    assert features.hash_sample(df, 500).count() == 1800
    assert features.hash_sample(df, -3).count() == features.hash_sample(df, 1).count()


def test_row_index_is_the_global_order(spark):
    demand = series(spark, range(60), 2).unionByName(series(spark, range(0, 60, 3), 1))
    indexed = ordering.with_row_index(demand.repartition(5), "pickup_hour", ["pu_location_id"])
    rows = indexed.orderBy("pickup_hour", "pu_location_id").collect()
    assert [r.row_index for r in rows] == list(range(80))


def test_time_split_never_cuts_an_hour(spark):
    demand = series(spark, range(50), 1).unionByName(series(spark, range(50), 2))
    train, test = ml.time_split(demand, 0.2)
    assert train.count() == 80 and test.count() == 20
    assert train.agg(F.max("pickup_hour")).first()[0] < test.agg(F.min("pickup_hour")).first()[0]


def test_expanding_folds_with_gap(spark):
    demand = series(spark, range(120))
    folds = ml.time_series_folds(demand, n_splits=5, gap=4)
    sizes = [(a.count(), b.count()) for a, b in folds]
    assert sizes == [(16, 20), (36, 20), (56, 20), (76, 20), (96, 20)]
    with pytest.raises(ValueError):
        ml.time_series_folds(demand.limit(3), n_splits=5)


def test_marked_folds_take_one_scan(spark, plan_of):
    demand = series(spark, range(120))
    sides = ml.fold_sides(ml.mark_folds(demand, n_splits=5, gap=4)).select("fold", "side", "demand")
    assert plan_of(sides).count("Scan") == 1 and "Exchange" not in plan_of(sides)
    rows = sides.collect()
    for i, (train, test) in enumerate(ml.time_series_folds(demand, n_splits=5, gap=4), start=1):
        for side, df in (("train", train), ("test", test)):
            want = sorted(r.demand for r in df.collect())
            assert df.columns == demand.columns
            assert sorted(r.demand for r in rows if (r.fold, r.side) == (i, side)) == want
    # Hours with several rows stay whole, and a gap of all rows before leaves none to train on.
    double = demand.unionByName(series(spark, range(120), zone=2))
    folds = ml.time_series_folds(double, n_splits=3, gap=500)
    assert [a.count() for a, _ in folds] == [0, 0, 0]
    assert sum(b.count() for _, b in folds) == 180


def test_spine_fills_the_calendar(spark):
    known = full(series(spark, (0, 5, 30), zone=1).unionByName(series(spark, (3, 5), zone=2)))
    dense = features.hourly_spine(known)
    assert dense.dtypes == known.dtypes and dense.count() == 2 * 31
    rows = {(r.pu_location_id, r.pickup_hour): r for r in dense.collect()}
    there = {(r.pu_location_id, r.pickup_hour): r for r in known.collect()}
    assert {k: rows[k] for k in there} == there
    assert sum(r.demand for r in rows.values()) == sum(r.demand for r in there.values())
    missing = rows[2, T0 + timedelta(hours=30)]
    assert (missing.demand, missing.hour, missing.temperature_f) == (0, 6, 36.0)
    assert rows[1, T0 + timedelta(hours=7)].temperature_f is None
    assert features.hourly_spine(known.limit(0)).count() == 0


def test_portable_hash_equals_md5(spark):
    import hashlib

    from tripmart.functions import portable_bucket

    df = spark.createDataFrame([(1, "a"), (None, "é"), (7, None)], "i int, s string")
    got = [r.b for r in df.select(portable_bucket(["i", "s"], 1000, 5).alias("b")).collect()]
    want = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 1000 for t in ("5|1|a", "5||é", "5|7|")]
    assert got == want


def test_gains_and_permutation_find_a_planted_signal(spark, tmp_path):
    spec = ml.ModelSpec(["a", "b", "c"], "y", 2, max_depth=3, max_iter=5)
    rows = spark.range(600).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("c"))
    rows = rows.withColumn("y", F.col("b") * 10 + F.col("a"))
    model = ml.fit(rows, spec)
    path = str(tmp_path / "model")
    model.write().save(path)
    gains = {r.feature: r for r in ml.split_gains(spark, path, model, spec).collect()}
    assert set(gains) == {"a", "b", "c"} and gains["b"].gain > 10 * max(gains["a"].gain, gains["c"].gain)
    assert sum(r.splits for r in gains.values()) > 5
    first = ml.permutation_importance(model, rows, spec, ["id"], bucket_rows=100)
    again = ml.permutation_importance(model, rows.repartition(5), spec, ["id"], bucket_rows=100)
    rise = {r.feature: r.rise for r in first.collect()}
    assert rise["b"] > 10 > abs(rise["a"]) and abs(rise["c"]) < 1
    assert {r.feature: round(r.rise, 9) for r in again.collect()} == {k: round(v, 9) for k, v in rise.items()}


def test_random_split_ignores_partitioning(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    train, test = ml.random_split(df)
    again, _ = ml.random_split(df.repartition(7))
    assert train.exceptAll(again).count() == 0
    assert train.count() + test.count() == 1000 and 140 < test.count() < 260


def test_metrics_and_their_edges(spark):
    schema = "demand double, predicted_demand double"
    row = forecast.metrics(spark.createDataFrame([(10.0, 12.0), (0.0, 1.0), (20.0, 19.0)], schema)).first()
    assert row.rmse == pytest.approx((6 / 3) ** 0.5) and row.mae == pytest.approx(4 / 3)
    assert row.mape == pytest.approx((0.2 + 0.05) / 2)
    assert row.r2 == pytest.approx(1 - 6 / 200)
    flat = forecast.metrics(spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], schema)).first()
    assert flat.r2 == 1.0
    single = forecast.metrics(spark.createDataFrame([(0.0, 3.0)], schema)).first()
    assert single.mape == 0.0 and single.r2 == 1.0
    better = forecast.with_baseline(forecast.metrics(spark.createDataFrame([(5.0, 4.0)], schema)))
    assert better.first().beats_paper


def test_score_demand_clips_rounds_and_labels(spark):
    df = spark.createDataFrame([(10, 132, -2.0), (0, 7, 1.26)],
                               "demand int, pu_location_id smallint, prediction double")
    clipped, zero = forecast.score_demand(df).collect()
    assert (clipped.predicted_demand, clipped.abs_error, clipped.pct_error) == (0.0, 10.0, 100.0)
    assert clipped.zone_name == "JFK Airport"
    assert zero.predicted_demand == 1.3 and zero.pct_error is None and zero.zone_name == "Zone 7"


def zones(spark):
    return spark.createDataFrame(
        [(132, "Queens", "JFK Airport", 40.6413, -73.7781),
         (138, "Queens", "LaGuardia Airport", 40.7769, -73.8740),
         (161, "Manhattan", "Midtown Center", 40.7580, -73.9777),
         (7, "Queens", "Nowhere", None, None)],
        "location_id int, borough string, zone string, latitude double, longitude double")


def requests(spark, *pairs, **changes):
    base = {"passenger_count": 1, "ratecode_id": 1, "hour": 8, "day_of_week": 2, "month": 12,
            "temperature_f": 34.0, "precipitation_mm": 0.0, "payment_type": 1, **changes}
    df = spark.createDataFrame(list(pairs), "pu_location_id int, do_location_id int")
    return df.withColumns({k: F.lit(v) for k, v in base.items()})


def test_routes(spark):
    got = {(r.pu_location_id, r.do_location_id): r for r in geo.route_estimates(
        requests(spark, (132, 161), (132, 138), (132, 132), (999, 132), (132, 998), (7, 132)),
        zones(spark)).collect()}
    assert got[(132, 161)].can_predict and got[(132, 161)].trip_distance > 10
    assert got[(132, 161)].trip_distance != got[(132, 138)].trip_distance
    same = got[(132, 132)]
    assert same.same_zone and not same.can_predict and same.trip_distance == 0
    assert got[(999, 132)].route_error == "unknown pickup zone"
    assert got[(132, 998)].route_error == "unknown dropoff zone"
    assert got[(7, 132)].route_error == "missing centroid coordinates"


def test_rule_prices_and_rejections(spark):
    z = zones(spark)
    card = forecast.score_fare_tip(requests(spark, (132, 161), (132, 132)), z)
    rows = {r.do_location_id: r for r in card.collect()}
    priced = rows[161]
    assert priced.valid and priced.predicted_fare == pytest.approx(
        round(3 + 2.5 * priced.trip_distance, 2), abs=0.011)
    assert priced.predicted_tip_percent == 15.0 and not priced.model_used
    assert rows[132].reject_reason == "same zone" and rows[132].predicted_fare is None
    cash = forecast.score_fare_tip(requests(spark, (132, 161), payment_type=2, hour=17), z).first()
    assert cash.predicted_tip_amount == 0
    assert cash.predicted_fare == pytest.approx(priced.predicted_fare + 2.5)
    bad = forecast.score_fare_tip(requests(spark, (132, 161), passenger_count=7), z).first()
    assert bad.reject_reason == "passenger_count out of range"


def test_models_price_requests(spark):
    rows = spark.range(300).select(
        (F.col("id") % 30 + 1).cast("float").alias("trip_distance"),
        F.lit(132).cast("smallint").alias("pu_location_id"),
        F.lit(161).cast("smallint").alias("do_location_id"),
        F.lit(1).cast("smallint").alias("passenger_count"),
        F.lit(1).cast("tinyint").alias("ratecode_id"),
        F.lit(1).cast("tinyint").alias("payment_type"),
        (F.col("id") % 24).cast("tinyint").alias("hour"),
        (F.col("id") % 7 + 1).cast("tinyint").alias("day_of_week"),
        F.lit(1).cast("tinyint").alias("month"),
        F.lit(40.0).cast("float").alias("temperature_f"),
        F.lit(0.0).cast("float").alias("precipitation_mm"),
        ((F.col("id") % 30 + 1) * 3).cast("decimal(12,2)").alias("fare_amount"),
        F.lit(18.0).cast("float").alias("tip_percent"),
    )
    quick = {"max_iter": 3, "max_depth": 3}
    fares = features.fare_features(rows)
    fare_model, _ = ml.train_fare(fares, spec=ml.FARE_MODEL._replace(**quick))
    tip_model, scores = ml.train_tip(fares, spec=ml.TIP_MODEL._replace(**quick))
    assert scores.first().n_features == 14
    priced = forecast.score_fare_tip(
        requests(spark, (132, 161), (132, 132)), zones(spark),
        fare_model=fare_model, tip_model=tip_model).collect()
    ok, rejected = sorted(priced, key=lambda r: not r.valid)
    assert ok.model_used and ok.predicted_tip_percent == pytest.approx(18.0, abs=0.5)
    assert 0 < ok.predicted_fare <= 90 and rejected.reject_reason == "same zone"


def test_only_valid_requests_go_through_the_models(spark):
    """rejected requests keep their row without a price and cost no prediction."""
    seen = []

    class Model:
        def transform(self, rows):
            seen.append(sorted(r.passenger_count for r in rows.collect()))
            return rows.withColumn("prediction", F.lit(10.0))

    asked = requests(spark, (132, 161), (132, 132)).unionByName(
        requests(spark, (132, 161), passenger_count=7)
    )
    priced = forecast.score_fare_tip(asked, zones(spark), fare_model=Model(), tip_model=Model())
    rows = sorted(priced.collect(), key=lambda r: (r.reject_reason or "", r.passenger_count))
    assert [len(s) for s in seen] == [1, 1]
    assert [(r.predicted_fare, r.total_amount, r.model_used) for r in rows] == [
        (10.0, 11.0, True), (None, None, None), (None, None, None)]


def test_fare_rows_parse_each_payload_once(spark, tmp_path):
    """every filter and feature used to parse the payload again."""
    from tripmart.catalog import shapes

    ts = datetime(2024, 1, 2, 5)
    rows = [(i, ts, i, "click", 10.0 + i, '{"k": %d}' % (i + 1)) for i in range(4)]
    spark.createDataFrame(
        [*rows, (4, ts, 4, "view", None, None)],
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    ).write.parquet(str(tmp_path / "events.parquet"))
    found = shapes.fare_tip(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1
    # The tip of event 3 is three quarters of its fare; without a fare there is no row.
    kept = sorted((round(float(r.trip_distance), 4), float(r.fare_amount)) for r in found.collect())
    assert kept == [(round(0.1 * (i + 1), 4), 10.0 + i) for i in range(4)]


def test_importance_shares(spark):
    gains = spark.createDataFrame([("a", 6.0), ("b", 3.0), ("c", 1.0)], "feature string, gain double")
    rows = ml.importance_shares(gains, 2).orderBy("rank").collect()
    assert [r.share_pct for r in rows] == pytest.approx([60.0, 30.0])
    assert rows[-1].coverage_pct == pytest.approx(90.0)


def test_models_train_and_score(spark, tmp_path):
    quick = {"max_iter": 4, "max_depth": 3}
    demand = full(series(spark, range(400), 132).unionByName(series(spark, range(400), 50)))
    model, scores = ml.train_demand(
        features.demand_features(demand), spec=ml.DEMAND_MODEL._replace(**quick), cv_folds=2)
    row = scores.first()
    assert row.folds == 2 and row.cv_rmse_mean > 0
    assert row.n_features == 24 and 1 <= row.n_trees <= 4 and row.rmse > 0
    rows = features.demand_features(demand).withColumn("temperature_f", F.lit(None).cast("float"))
    counted = ml.row_accounting(model, {"no weather": rows}).first()
    assert counted.rows_given == counted.rows_scored > 0
    out = Layout(str(tmp_path / "lake"))
    model.write().save(out("models/demand"))
    demand.write.parquet(out("gold_demand_features"))
    run_score(spark, out, out("models/demand"), "2024-01-10")
    scored = spark.read.parquet(out("demand_scores"))
    export = spark.read.option("header", True).csv(out("demand_holdout_csv"))
    assert 0 < scored.count() == export.count() and scored.filter("predicted_demand IS NULL").count() == 0
    importance = ml.importance(spark, model, ml.DEMAND_MODEL).collect()
    assert sum(r.share_pct for r in importance) == pytest.approx(100, abs=1)
    ml.write_metrics(scores, str(tmp_path / "demand"))
    from tripmart.sources import read_metrics

    saved = read_metrics(spark, {"demand": str(tmp_path / "demand"), "fare": str(tmp_path / "no")})
    assert {r.metric for r in saved.collect()} >= {"rmse", "mae", "r2"}
    cv = ml.cross_validate(features.demand_features(demand), n_splits=2, gap=4,
                           spec=ml.DEMAND_MODEL._replace(max_iter=2, max_depth=2)).first()
    assert cv.folds == 2 and cv.cv_rmse_mean > 0
