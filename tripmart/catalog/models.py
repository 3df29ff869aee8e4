"""Forecast evaluation, splits, request scoring and model training."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import features, forecast, ml, ordering
from ..plans import dashboard as q
from ..session import scratch_path
from . import shapes
from .dashboard import rounded
from .quality import HAVERSINE
from .registry import query

# --- Scoring and evaluation ---------------------------------------------------


@query("score_demand", "SELECT * EXCLUDE (p) FROM scored")
def _(spark, sf_dir):
    return shapes.scored(spark, sf_dir)


_METRICS = """
    SELECT count(*) AS "rows", round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
      round(coalesce(avg(CASE WHEN demand > 0 THEN abs(e) / demand END), 0), 6) AS mape,
      round(CASE WHEN var_pop(demand) > 0 THEN 1 - sum(e * e) / (var_pop(demand) * count(*))
        ELSE 1 END, 6)::DOUBLE AS r2
"""


@query(
    "forecast_metrics",
    f"""
    SELECT *, 38.51::DOUBLE AS paper_rmse, 0.97::DOUBLE AS paper_r2, rmse < 38.51 AS beats_paper
    FROM ({_METRICS} FROM (SELECT *, demand - predicted_demand AS e FROM scored))
    """,
)
def _(spark, sf_dir):
    scores = forecast.with_baseline(forecast.metrics(shapes.scored(spark, sf_dir)))
    return rounded(scores, "rmse", "mae", "mape", "r2")


@query(
    "forecast_metrics_by_zone",
    f"""
    {_METRICS.replace("SELECT", "SELECT pu_location_id,", 1).replace(", 6)", ", 10)")}
    FROM (SELECT *, demand - predicted_demand AS e FROM scored) GROUP BY 1
    """,
)
def _(spark, sf_dir):
    scores = forecast.metrics(shapes.scored(spark, sf_dir), by=["pu_location_id"])
    # Errors are multiples of 0.05 and a zone has few rows: ten digits hold many of the
    # figures in full, where six would cut them on a rounding border.
    return scores.withColumns({c: F.round(c, 10) for c in ("rmse", "mae", "mape", "r2")})


_PROFILE = """count(demand) AS "rows", round(avg(demand), 6) AS actual_mean,
      round(avg(predicted_demand), 6) AS predicted_mean, round(avg(abs_error), 6) AS mae,
      round(avg(pct_error), 6) AS mape"""
_PROFILE_COLUMNS = ["actual_mean", "predicted_mean", "mae", "mape"]


@query("forecast_by_hour", f'SELECT "hour", {_PROFILE} FROM scored GROUP BY 1')
def _(spark, sf_dir):
    return rounded(forecast.by_hour(shapes.scored(spark, sf_dir)), *_PROFILE_COLUMNS)


@query(
    "forecast_by_day",
    """
    SELECT pickup_hour::DATE AS pickup_date, sum(demand)::BIGINT AS actual_sum,
      round(sum(predicted_demand), 6) AS predicted_sum
    FROM scored GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return rounded(forecast.by_day(shapes.scored(spark, sf_dir)), "predicted_sum")


_ZONE_TYPE = """CASE WHEN is_manhattan_core = 1 THEN 'Manhattan core'
      WHEN is_airport = 1 THEN 'Sân bay' ELSE 'Bình thường' END"""


@query(
    "forecast_by_zone_type",
    f"SELECT {_ZONE_TYPE} AS zone_type, {_PROFILE} FROM scored GROUP BY 1",
)
def _(spark, sf_dir):
    return rounded(forecast.by_zone_type(shapes.scored(spark, sf_dir)), *_PROFILE_COLUMNS)


@query(
    "forecast_by_holiday",
    "\nUNION ALL ".join(
        f"""SELECT '{side}' AS period, round(coalesce(avg(demand), 0), 6)::DOUBLE AS actual_mean,
          round(coalesce(avg(predicted_demand), 0), 6)::DOUBLE AS predicted_mean,
          round(coalesce(avg(abs_error), 0), 6)::DOUBLE AS mae
        FROM scored WHERE strftime(pickup_hour, '%m-%d') {op} '01-15'"""
        for side, op in (("holiday", "="), ("other", "<>"))
    ),
)
def _(spark, sf_dir):
    rows = forecast.by_holiday(shapes.scored(spark, sf_dir), "01-15")
    return rounded(rows, "actual_mean", "predicted_mean", "mae")


@query(
    "worst_errors",
    """
    SELECT pickup_hour, pu_location_id, zone_name, demand, predicted_demand, abs_error, pct_error,
      temperature_f, precipitation_mm
    FROM scored ORDER BY abs_error DESC, pickup_hour, pu_location_id LIMIT 10
    """,
)
def _(spark, sf_dir):
    return forecast.worst_errors(shapes.scored(spark, sf_dir))


_FIRST = """
    SELECT pickup_hour, pu_location_id, zone_name, demand, predicted_demand, abs_error
    FROM scored ORDER BY pickup_hour, pu_location_id LIMIT 30
"""


@query("forecast_first_rows", _FIRST)
def _(spark, sf_dir):
    return forecast.first_rows(shapes.scored(spark, sf_dir))


@query(
    "forecast_top_zones",
    """
    SELECT pu_location_id, pickup_hour, demand, predicted_demand FROM scored
    WHERE pu_location_id IN (
      SELECT pu_location_id FROM scored GROUP BY 1 ORDER BY avg(demand) DESC, 1 LIMIT 8)
    ORDER BY pickup_hour, pu_location_id LIMIT 40
    """,
)
def _(spark, sf_dir):
    rows = forecast.sample_top_zones(shapes.scored(spark, sf_dir))
    return rows.select("pu_location_id", "pickup_hour", "demand", "predicted_demand")


@query(
    "enrich_predictions",
    f"""
    SELECT pu_location_id, pickup_hour, hour(pickup_hour)::INT AS hour_of_day,
      dayname(pickup_hour) AS day_name, isodow(pickup_hour)::INT AS day_order,
      {_ZONE_TYPE} AS zone_type
    FROM scored
    """,
)
def _(spark, sf_dir):
    return forecast.enrich_predictions(shapes.scored(spark, sf_dir)).select(
        "pu_location_id", "pickup_hour", "hour_of_day", "day_name", "day_order", "zone_type"
    )


_FILTERS = {
    "dry_warm_core": (
        {"kind": "core", "weather": "dry_warm", "day_type": "weekday"},
        f"{_ZONE_TYPE} = 'Manhattan core' AND precipitation_mm = 0 AND temperature_f >= 36 "
        "AND is_weekend = 0",
    ),
    "rain_weekend": (
        {"weather": "rain", "day_type": "weekend"},
        "precipitation_mm > 0 AND is_weekend = 1",
    ),
    "cold_airport": (
        {"kind": "airport", "weather": "cold"},
        f"{_ZONE_TYPE} = 'Sân bay' AND temperature_f < 36",
    ),
    "jfk_days": (
        {"zone_name": "JFK Airport", "first_day": "2024-01-05", "last_day": "2024-01-20"},
        "zone_name = 'JFK Airport' AND pickup_hour >= TIMESTAMP '2024-01-05' "
        "AND pickup_hour < TIMESTAMP '2024-01-21'",
    ),
    "holidays": ({"day_type": "holiday"}, "is_holiday = 1"),
}


def _register_filter(name, criteria, condition):
    @query(
        f"forecast_filter_{name}",
        f"SELECT pu_location_id, pickup_hour, demand, predicted_demand FROM scored WHERE {condition}",
    )
    def _(spark, sf_dir):
        rows = forecast.filter_predictions(shapes.scored(spark, sf_dir), **criteria)
        return rows.select("pu_location_id", "pickup_hour", "demand", "predicted_demand")


for _name, (_criteria, _condition) in _FILTERS.items():
    _register_filter(_name, _criteria, _condition)


# --- Requests -------------------------------------------------------------------


def _requests(spark, sf_dir):
    e = F.col("offset")
    return shapes.typed_trips(spark, sf_dir).select(
        e.alias("request_id"),
        "pu_location_id",
        "do_location_id",
        (e % 8).cast("int").alias("passenger_count"),
        (e % 5 + 1).cast("int").alias("ratecode_id"),
        F.hour("pickup_datetime").alias("hour"),
        F.dayofweek("pickup_datetime").alias("day_of_week"),
        F.month("pickup_datetime").alias("month"),
        (20 + e % 30).cast("double").alias("temperature_f"),
        F.when(e % 4 == 0, 0.5).otherwise(0.0).alias("precipitation_mm"),
        (e % 4 + 1).cast("int").alias("payment_type"),
        "trip_distance",
    )


_REQUESTS = """
    SELECT "offset" AS request_id, pu_location_id, do_location_id,
      ("offset" % 8)::INT AS passenger_count, hour(pickup_datetime) AS "hour",
      dayofweek(pickup_datetime) + 1 AS day_of_week, month(pickup_datetime) AS "month", 20 + "offset" % 30 AS temperature_f,
      CASE WHEN "offset" % 4 = 0 THEN 0.5 ELSE 0.0 END AS precipitation_mm,
      ("offset" % 4 + 1)::INT AS payment_type, trip_distance
    FROM trips
"""


@query(
    "validate_requests",
    f"""
    SELECT request_id, reject_reason, reject_reason IS NULL AS valid FROM (
      SELECT request_id,
        CASE WHEN p.location_id IS NULL THEN 'unknown pickup zone'
          WHEN d.location_id IS NULL THEN 'unknown dropoff zone'
          WHEN p.latitude IS NULL OR d.latitude IS NULL THEN 'missing centroid coordinates'
          WHEN passenger_count NOT BETWEEN 1 AND 6 THEN 'passenger_count out of range'
          WHEN pu_location_id = do_location_id THEN 'same zone' END AS reject_reason
      FROM ({_REQUESTS}) LEFT JOIN zones p ON pu_location_id = p.location_id
      LEFT JOIN zones d ON do_location_id = d.location_id)
    """,
)
def _(spark, sf_dir):
    requests = _requests(spark, sf_dir).drop("trip_distance")
    routed = forecast.route_estimates(
        requests, shapes.zone_table(spark, sf_dir), proven_rows=shapes.ZONES
    )
    return forecast.validate_requests(routed).select("request_id", "reject_reason", "valid")


@query(
    "request_features",
    f"""
    SELECT request_id, trip_distance, pu_location_id, do_location_id,
      passenger_count::DOUBLE AS passenger_count, (request_id % 5 + 1)::DOUBLE AS ratecode_id,
      "hour", day_of_week, "month", temperature_f::DOUBLE AS temperature_f,
      precipitation_mm::DOUBLE AS precipitation_mm,
      ("hour" IN (7, 8, 9, 17, 18, 19))::TINYINT AS is_rush_hour,
      (day_of_week IN (5, 6))::TINYINT AS is_weekend,
      (precipitation_mm > 0)::TINYINT AS is_raining, (temperature_f < 36)::TINYINT AS is_cold
    FROM ({_REQUESTS})
    """,
)
def _(spark, sf_dir):
    """The full row in the models' column order."""
    return forecast.request_features(_requests(spark, sf_dir)).select(
        "request_id", *K.FARE_TIP_FEATURES
    )


@query(
    "fallback_fare_tip",
    f"""
    SELECT request_id, fare AS predicted_fare, pct AS predicted_tip_percent,
      round_even(fare * (pct / 100) * 100, 0) / 100 AS predicted_tip_amount,
      round_even((fare + round_even(fare * (pct / 100) * 100, 0) / 100) * 100, 0) / 100
        AS total_amount
    FROM (
      SELECT request_id,
        round_even((3.0::DOUBLE + trip_distance * 2.5::DOUBLE
          + CASE WHEN "hour" BETWEEN 16 AND 20 THEN 2.5 ELSE 0 END::DOUBLE) * 100, 0) / 100 AS fare,
        CASE WHEN payment_type = 1 THEN 15 ELSE 0 END::DOUBLE AS pct
      FROM ({_REQUESTS}))
    """,
)
def _(spark, sf_dir):
    return forecast.fallback_fare_tip(_requests(spark, sf_dir)).select(
        "request_id", "predicted_fare", "predicted_tip_percent", "predicted_tip_amount",
        "total_amount",
    )


_PRICED = f"""
    SELECT request_id, valid AS priced, CASE WHEN valid THEN fare END AS predicted_fare,
      CASE WHEN valid THEN pct END AS predicted_tip_percent,
      CASE WHEN valid THEN tip END AS predicted_tip_amount,
      CASE WHEN valid THEN round_even((fare + tip) * 100, 0) / 100 END AS total_amount
    FROM (
      SELECT *, round_even(fare * (pct / 100) * 100, 0) / 100 AS tip
      FROM (
        SELECT request_id, miles IS NOT NULL AND miles > 0 AND miles < 100
            AND passenger_count BETWEEN 1 AND 6 AND pu_location_id <> do_location_id AS valid,
          round_even((3.0::DOUBLE + miles * 2.5::DOUBLE
            + CASE WHEN "hour" BETWEEN 16 AND 20 THEN 2.5 ELSE 0 END::DOUBLE) * 100, 0) / 100 AS fare,
          CASE WHEN payment_type = 1 THEN 15 ELSE 0 END::DOUBLE AS pct
        FROM (
          SELECT r.*, round({HAVERSINE}, 3) AS miles FROM (SELECT * EXCLUDE (trip_distance) FROM ({_REQUESTS})) r
          LEFT JOIN zones p ON pu_location_id = p.location_id
          LEFT JOIN zones d ON do_location_id = d.location_id)))
"""
_PRICES = ["predicted_fare", "predicted_tip_percent", "predicted_tip_amount", "total_amount"]


@query("score_fare_tip", _PRICED)
def _(spark, sf_dir):
    requests = _requests(spark, sf_dir).drop("trip_distance")
    scored = forecast.score_fare_tip(requests, shapes.zone_table(spark, sf_dir))
    return scored.select("request_id", F.col("total_amount").isNotNull().alias("priced"), *_PRICES)


@query("score_fare_tip_models", f"SELECT request_id, priced, priced AS plausible FROM ({_PRICED})")
def _(spark, sf_dir):
    """Prices from trained models: for valid requests only, never negative, tips for cards only."""
    # Hundreds of passes over these rows follow: as many even parts as there are cores.
    parts = spark.sparkContext.defaultParallelism
    rows = shapes.stored(_fare_rows(spark, sf_dir).repartition(parts))
    # A level of a tree is a short job, and most of a model's time its tasks leave cores idle.
    with ThreadPoolExecutor(1) as beside:
        fare = beside.submit(inheritable_thread_target(ml.fit), rows, ml.FARE_MODEL)
        tip = ml.fit(features.tip_features(rows), ml.TIP_MODEL)
        fare = fare.result()
    requests = _requests(spark, sf_dir).drop("trip_distance")
    scored = forecast.score_fare_tip(
        requests,
        shapes.zone_table(spark, sf_dir),
        fare_model=fare,
        tip_model=tip,
        proven_rows=shapes.ZONES,
    )
    card = F.col("payment_type") == 1
    plausible = (
        F.col("model_used")
        & (F.col("predicted_fare") >= 0)
        & (card | (F.col("predicted_tip_amount") == 0))
        & (F.abs(F.col("predicted_fare") + F.col("predicted_tip_amount") - F.col("total_amount")) < 0.011)
    )
    return scored.select(
        "request_id",
        F.col("total_amount").isNotNull().alias("priced"),
        F.coalesce(plausible, F.lit(False)).alias("plausible"),
    )


# --- Splits ----------------------------------------------------------------------


@query(
    "time_split",
    """
    SELECT side, count(*) AS "rows", min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour
    FROM (
      SELECT pickup_hour, CASE WHEN pickup_hour < (
          SELECT pickup_hour FROM (
            SELECT pickup_hour, row_number() OVER (ORDER BY pickup_hour) AS rn,
              count(*) OVER () AS n FROM demand)
          WHERE rn = floor(n * 0.8::DOUBLE) + 1) THEN 'train' ELSE 'test' END AS side
      FROM demand) GROUP BY 1
    """,
)
def _(spark, sf_dir):
    train, test = ml.time_split(shapes.stored(shapes.demand(spark, sf_dir)), 0.2)
    sides = train.select(F.lit("train").alias("side"), "pickup_hour").unionByName(
        test.select(F.lit("test").alias("side"), "pickup_hour")
    )
    return sides.groupBy("side").agg(
        F.count("*").alias("rows"),
        F.min("pickup_hour").alias("first_hour"),
        F.max("pickup_hour").alias("last_hour"),
    )


@query(
    "time_series_folds",
    """
    SELECT i + 1 AS fold,
      (SELECT count(*) FROM demand WHERE pickup_hour < a) AS train_rows,
      (SELECT count(*) FROM demand WHERE pickup_hour >= b AND (c IS NULL OR pickup_hour < c))
        AS test_rows
    FROM (
      SELECT i, (SELECT pickup_hour FROM ranked WHERE rn = first_row - 24) AS a,
        (SELECT pickup_hour FROM ranked WHERE rn = first_row) AS b,
        (SELECT pickup_hour FROM ranked WHERE rn = first_row + block AND i < 4) AS c
      FROM (SELECT i, n // 6 AS block, n - (5 - i) * (n // 6) AS first_row
            FROM (SELECT count(*) AS n FROM demand), range(5) t(i)))
    """.replace(
        "FROM ranked",
        "FROM (SELECT pickup_hour, row_number() OVER (ORDER BY pickup_hour) - 1 AS rn FROM demand)",
    ),
)
def _(spark, sf_dir):
    """All folds from one scan of the marked rows."""
    marked = ml.mark_folds(shapes.stored(shapes.demand(spark, sf_dir)))
    return ml.fold_sides(marked).groupBy(F.col("fold").cast("bigint").alias("fold")).agg(
        F.count_if(F.col("side") == "train").alias("train_rows"),
        F.count_if(F.col("side") == "test").alias("test_rows"),
    )


@query(
    "early_stopping_tail",
    """
    SELECT pickup_hour >= (SELECT pickup_hour FROM (
        SELECT pickup_hour, row_number() OVER (ORDER BY pickup_hour) AS rn, count(*) OVER () AS n
        FROM demand) WHERE rn = floor(n * 0.9::DOUBLE) + 1) AS validates,
      count(*) AS "rows", min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour
    FROM demand GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """The last tenth of the rows in time decides when training stops."""
    marked = ml.early_stopping_tail(shapes.stored(shapes.demand(spark, sf_dir)))
    return marked.groupBy(F.col("_validation").alias("validates")).agg(
        F.count("*").alias("rows"),
        F.min("pickup_hour").alias("first_hour"),
        F.max("pickup_hour").alias("last_hour"),
    )


@query(
    "global_row_index",
    """
    SELECT pu_location_id, pickup_hour,
      row_number() OVER (ORDER BY pickup_hour, pu_location_id) - 1 AS row_index
    FROM demand
    """,
)
def _(spark, sf_dir):
    demand = shapes.stored(shapes.demand(spark, sf_dir)).select("pu_location_id", "pickup_hour")
    return ordering.with_row_index(demand, "pickup_hour", ["pu_location_id"])


@query(
    "random_split",
    """
    SELECT CASE WHEN ('0x' || left(md5('42|' || "offset" || '|' || taxi_type), 8))::BIGINT % 10000
        < 2000 THEN 'test' ELSE 'train' END AS side,
      "offset", pu_location_id FROM trips
    """,
)
def _(spark, sf_dir):
    """Which trips train and which test, as any engine draws them."""
    trips = shapes.typed_trips(spark, sf_dir)
    sides = zip(("train", "test"), ml.random_split(trips, keys=["offset", "taxi_type"]), strict=True)
    train, test = (df.select(F.lit(side).alias("side"), "offset", "pu_location_id") for side, df in sides)
    return train.unionAll(test)


@query(
    "importance_shares",
    """
    SELECT feature, gain, round(share_pct, 6) AS share_pct, "rank",
      round(sum(share_pct) OVER (ORDER BY "rank"), 6) AS coverage_pct
    FROM (
      SELECT feature, gain, gain / sum(gain) OVER () * 100 AS share_pct,
        row_number() OVER (ORDER BY gain DESC, feature)::INT AS "rank"
      FROM (SELECT 'hour_' || lpad("hour"::VARCHAR, 2, '0') AS feature,
              sum(demand)::DOUBLE AS gain FROM demand GROUP BY 1))
    QUALIFY "rank" <= 10
    """,
)
def _(spark, sf_dir):
    """Demand by hour of day stands in for the gain of a feature."""
    name = F.format_string("hour_%02d", F.col("hour"))
    gains = (
        shapes.demand(spark, sf_dir)
        .groupBy(name.alias("feature"))
        .agg(F.sum("demand").cast("double").alias("gain"))
    )
    return rounded(ml.importance_shares(shapes.stored(gains), 10), "share_pct", "coverage_pct")


# --- Training (no SQL twin for the scores) -----------------------------------------


_PLANTED = ml.ModelSpec(
    ["trip_distance", "pu_location_id", "hour", "day_of_week", "passenger_count"],
    "label", 2, max_depth=4, max_iter=10,
)


@query(
    "feature_gains",
    """
    SELECT method, feature, 5::BIGINT AS features, true AS has_gain
    FROM (
      SELECT unnest(['trip_distance', 'pu_location_id', 'hour', 'day_of_week', 'passenger_count'])
          AS feature,
        unnest([abs(corr(trip_distance, label)), abs(corr(pu_location_id, label)),
                abs(corr("hour", label)), abs(corr(day_of_week, label)),
                abs(corr(passenger_count, label))]) AS strength
      FROM (SELECT *, trip_distance::DOUBLE * 3 + "hour" / 4.0::DOUBLE AS label FROM fare_tip)
      ORDER BY strength DESC LIMIT 1),
      (VALUES ('split gain'), ('permutation')) m(method)
    """,
)
def _(spark, sf_dir):
    """A model of a planted signal: what its trees and a permutation say matters most."""
    trips = shapes.fare_tip(spark, sf_dir).drop("gold_processed_timestamp").withColumns(
        {
            "label": F.col("trip_distance").cast("double") * 3 + F.col("hour") / F.lit(4.0),
            "row": F.monotonically_increasing_id(),
        }
    )
    rows = shapes.stored(trips)
    model = ml.fit(rows, _PLANTED)
    path = scratch_path(spark, "model")
    model.write().save(path)
    gains = ml.split_gains(spark, path, model, _PLANTED).select("feature", "gain")
    permuted = ml.permutation_importance(model, rows, _PLANTED, ["row"])
    found = None
    for name, scores in (("split gain", gains), ("permutation", permuted.select("feature", F.col("rise").alias("gain")))):
        scores = shapes.stored(scores)
        one = ml.importance_shares(scores, 1).select(
            F.lit(name).alias("method"),
            "feature",
            scores.agg(F.count("*")).scalar().alias("features"),
            (F.col("gain") > 0).alias("has_gain"),
        )
        found = one if found is None else found.unionByName(one)
    return found


# The published model looks back a week; every zone has that many hours on the calendar.
@query("train_demand")
def _(spark, sf_dir):
    rows = features.demand_features(shapes.dense_demand(spark, sf_dir))
    _, scores = ml.train_demand(rows)
    return scores


@query("cross_validate")
def _(spark, sf_dir):
    """Spread of the error over five folds of all zones, with trees cut short to five."""
    rows = features.demand_features(shapes.dense_demand(spark, sf_dir))
    return ml.cross_validate(rows, spec=ml.DEMAND_MODEL._replace(max_iter=5))


def _fare_rows(spark, sf_dir):
    rows = features.fare_features(shapes.fare_tip(spark, sf_dir))
    return rows.drop("gold_processed_timestamp")


@query("train_fare")
def _(spark, sf_dir):
    _, scores = ml.train_fare(_fare_rows(spark, sf_dir))
    return scores


@query("train_tip")
def _(spark, sf_dir):
    _, scores = ml.train_tip(_fare_rows(spark, sf_dir))
    return scores


@query(
    "model_row_accounting",
    """
    SELECT part, count(*) AS rows_given, count(*) AS rows_scored
    FROM (SELECT 'demand' AS part FROM dense_demand
          UNION ALL SELECT 'no_weather' FROM dense_demand
          WHERE temperature_f IS NULL OR precipitation_mm IS NULL)
    GROUP BY part
    """,
)
def _(spark, sf_dir):
    """Every zone-hour gets a prediction, those without weather or history included.

    The demand model as it is trained, on the rows that have a history.
    """
    rows = shapes.stored(
        features.demand_features(shapes.dense_demand(spark, sf_dir), complete_only=False)
    )
    model, _ = ml.train_demand(rows.dropna(subset=features.REQUIRED_LAGS))
    parts = {
        "demand": rows,
        "no_weather": rows.filter("temperature_f IS NULL OR precipitation_mm IS NULL"),
    }
    return ml.row_accounting(model, parts).filter("rows_given > 0")


@query(
    "period_delta",
    """
    SELECT round((a.n - b.n)::DOUBLE / b.n * 100, 6) AS total_demand_change_pct,
      round((a.n / a.h::DOUBLE - b.n / b.h::DOUBLE) / (b.n / b.h::DOUBLE) * 100, 6)
        AS avg_hourly_demand_change_pct,
      round((a.z - b.z) / b.z * 100, 6) AS avg_active_zones_change_pct,
      round((a.d - b.d) / b.d * 100, 6) AS avg_demand_per_active_zone_change_pct,
      round((a.f - b.f) / b.f * 100, 6) AS avg_fare_amount_change_pct
    FROM (SELECT sum(total_demand) AS n, count(*) AS h, avg(active_zones) AS z,
            avg(avg_demand_per_active_zone) AS d,
            (SELECT sum(avg_fare_amount * trip_count) / sum(trip_count) FROM tl_payment
             WHERE m BETWEEN '1995-01' AND '1995-06') AS f
          FROM tl_hourly WHERE m BETWEEN '1995-01' AND '1995-06') a,
         (SELECT sum(total_demand) AS n, count(*) AS h, avg(active_zones) AS z,
            avg(avg_demand_per_active_zone) AS d,
            (SELECT sum(avg_fare_amount * trip_count) / sum(trip_count) FROM tl_payment
             WHERE m BETWEEN '1994-07' AND '1994-12') AS f
          FROM tl_hourly WHERE m BETWEEN '1994-07' AND '1994-12') b
    """.replace(
        "FROM tl_hourly",
        "FROM (SELECT m, t, sum(q) AS total_demand, count(*) AS active_zones, "
        "avg(q) AS avg_demand_per_active_zone FROM (SELECT strftime(l_shipdate, '%Y-%m') AS m, "
        "l_shipdate AS t, l_suppkey, count(*) AS q FROM lineitem GROUP BY ALL) GROUP BY 1, 2)",
    ).replace(
        "FROM tl_payment",
        "FROM (SELECT strftime(l_shipdate, '%Y-%m') AS m, l_returnflag, count(*) AS trip_count, "
        "avg(l_quantity) AS avg_fare_amount FROM lineitem GROUP BY ALL)",
    ),
)
def _(spark, sf_dir):
    """Half a year of line items against the half year before."""
    hourly, payment = _volume_marts(spark, sf_dir)
    row = q.summary(hourly, payment, "1995-01", "1995-06")
    delta = q.period_delta(row)
    return rounded(delta, *delta.columns)


def _volume_marts(spark, sf_dir):
    items = shapes.table(spark, sf_dir, "lineitem").withColumn(
        "pickup_year_month", F.date_format("l_shipdate", "yyyy-MM")
    )
    no_stamp = F.lit(None).cast("timestamp")
    per_zone = items.groupBy("pickup_year_month", "l_shipdate", "l_suppkey").agg(
        F.count("*").alias("demand")
    )
    hourly = (
        per_zone.groupBy("pickup_year_month", F.col("l_shipdate").alias("pickup_hour"))
        .agg(
            F.sum("demand").alias("total_demand"),
            F.count("*").alias("active_zones"),
            F.avg("demand").alias("avg_demand_per_active_zone"),
        )
        .withColumns(
            {
                "hour": F.hour("pickup_hour"),
                "avg_temperature_f": F.lit(None).cast("double"),
                "avg_precipitation_mm": F.lit(None).cast("double"),
                "source_gold_processed_timestamp": no_stamp,
                "dashboard_processed_timestamp": no_stamp,
            }
        )
    )
    flag = F.ascii("l_returnflag").alias("payment_type")
    payment = items.groupBy("pickup_year_month", flag).agg(
        F.count("*").alias("trip_count"),
        F.avg("l_quantity").alias("avg_fare_amount"),
        F.avg(F.lit(0.0)).alias("avg_tip_percent"),
    )
    return hourly, payment
