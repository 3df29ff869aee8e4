"""Scoring and evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import (
    day_label,
    is_airport,
    is_cold,
    is_core_zone,
    is_raining,
    is_rush_hour,
    is_weekend,
    percent_change,
    round_even,
    safe_ratio,
    zone_display_name,
    zone_type,
)
from ..session import materialize
from .geo import route_estimates
from .joins import sized

# --- Evaluation ----------------------------------------------------------


def metrics(
    df: DataFrame,
    actual: str = "demand",
    predicted: str = "predicted_demand",
    *,
    by: list[str] | None = None,
) -> DataFrame:
    """RMSE, MAE, MAPE over positive actuals, and R2, in one aggregation pass.

    R2 is 1 when the actual values do not vary; MAPE is 0 when none is positive.
    """
    y = F.col(actual).cast("double")
    err = y - F.col(predicted).cast("double")
    spread = F.var_pop(y) * F.count(err)
    r2 = F.when(spread > 0, 1 - F.sum(err * err) / spread).otherwise(1.0)
    grouped = df.groupBy(*(by or []))
    return grouped.agg(
        F.count(err).alias("rows"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.coalesce(F.avg(F.when(y > 0, F.abs(err) / y)), F.lit(0.0)).alias("mape"),
        r2.alias("r2"),
    )


def with_baseline(scores: DataFrame) -> DataFrame:
    """Add the published comparison point and whether it was beaten."""
    return scores.withColumns(
        {
            "paper_rmse": F.lit(K.BASELINE_RMSE),
            "paper_r2": F.lit(K.BASELINE_R2),
            "beats_paper": F.col("rmse") < K.BASELINE_RMSE,
        }
    )


def _error_profile() -> list[Column]:
    return [
        F.count("demand").alias("rows"),
        F.avg("demand").alias("actual_mean"),
        F.avg("predicted_demand").alias("predicted_mean"),
        F.avg("abs_error").alias("mae"),
        F.avg("pct_error").alias("mape"),
    ]


def by_hour(scored: DataFrame) -> DataFrame:
    return scored.groupBy("hour").agg(*_error_profile())


def by_day(scored: DataFrame) -> DataFrame:
    return scored.groupBy(F.to_date("pickup_hour").alias("pickup_date")).agg(
        F.sum("demand").alias("actual_sum"), F.sum("predicted_demand").alias("predicted_sum")
    )


def by_zone_type(scored: DataFrame) -> DataFrame:
    label = zone_type(F.col("is_airport"), F.col("is_manhattan_core"))
    return scored.groupBy(label.alias("zone_type")).agg(*_error_profile())


def by_holiday(scored: DataFrame, month_day: str = "12-25") -> DataFrame:
    """Error on one calendar day of the year against all other days.

    Both groups are always reported, with zeros when a group has no rows.
    """
    holiday = F.date_format("pickup_hour", "MM-dd") == month_day
    measures = {"actual_mean": "demand", "predicted_mean": "predicted_demand", "mae": "abs_error"}
    sides = {"holiday": holiday, "other": ~holiday}
    wide = scored.agg(
        *[
            F.coalesce(F.avg(F.when(cond, F.col(column))), F.lit(0.0)).alias(f"{side}_{name}")
            for side, cond in sides.items()
            for name, column in measures.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(side).alias("period"),
            *[F.col(f"{side}_{name}").alias(name) for name in measures],
        )
        for side in sides
    ]
    return wide.select(F.inline(F.array(*rows)))


def worst_errors(scored: DataFrame, n: int = 10) -> DataFrame:
    columns = [
        "pickup_hour", "pu_location_id", "zone_name", "demand", "predicted_demand", "abs_error",
        "pct_error", "temperature_f", "precipitation_mm",
    ]
    order = [F.desc("abs_error"), F.asc("pickup_hour"), F.asc("pu_location_id")]
    return scored.select(*columns).orderBy(*order).limit(n)


def first_rows(scored: DataFrame, n: int = 30) -> DataFrame:
    columns = [
        "pickup_hour", "pu_location_id", "zone_name", "demand", "predicted_demand", "abs_error",
    ]
    return scored.select(*columns).orderBy("pickup_hour", "pu_location_id").limit(n)


def sample_top_zones(scored: DataFrame, zones: int = 8, n: int = 40) -> DataFrame:
    """First rows by time of the zones with the highest mean demand."""
    top = (
        scored.groupBy("pu_location_id")
        .agg(F.avg("demand").alias("_mean"))
        .orderBy(F.desc("_mean"), "pu_location_id")
        .limit(zones)
        .select("pu_location_id")
    )
    kept = scored.join(sized(top, zones), "pu_location_id", "left_semi")
    return kept.orderBy("pickup_hour", "pu_location_id").limit(n)


# --- Enrichment and filters ------------------------------------------------


def enrich_predictions(scored: DataFrame) -> DataFrame:
    """Hour of day, day name with its display label, zone type."""
    day = F.date_format("pickup_hour", "EEEE")
    return scored.withColumns(
        {
            "hour_of_day": F.hour("pickup_hour"),
            "day_name": day,
            "day_order": F.weekday("pickup_hour") + 1,
            "day_label": day_label(day),
            "zone_type": zone_type(F.col("is_airport"), F.col("is_manhattan_core")),
        }
    )


_WEATHER_FILTERS = {
    "rain": lambda: F.col("precipitation_mm") > 0,
    "cold": lambda: F.col("temperature_f") < K.COLD_BELOW_F,
    "dry_warm": lambda: (F.col("precipitation_mm") == 0)
    & (F.col("temperature_f") >= K.COLD_BELOW_F),
}
_DAY_FILTERS = {
    "weekday": lambda: F.col("is_weekend") == 0,
    "weekend": lambda: F.col("is_weekend") == 1,
    "holiday": lambda: F.col("is_holiday") == 1,
}


def filter_predictions(
    scored: DataFrame,
    *,
    first_day: str | None = None,
    last_day: str | None = None,
    zone_name: str | None = None,
    kind: str | None = None,
    weather: str | None = None,
    day_type: str | None = None,
) -> DataFrame:
    """Predictions that match every given criterion (both days inclusive).

    ``kind`` is ``airport``, ``core`` or ``normal``; ``weather`` is ``rain``,
    ``cold`` or ``dry_warm``; ``day_type`` is ``weekday``, ``weekend`` or
    ``holiday``.
    """
    day = F.to_date("pickup_hour")
    conditions = []
    if first_day is not None:
        conditions.append(day >= F.lit(first_day).cast("date"))
    if last_day is not None:
        conditions.append(day <= F.lit(last_day).cast("date"))
    if zone_name is not None:
        conditions.append(F.col("zone_name") == zone_name)
    if kind is not None:
        label = zone_type(F.col("is_airport"), F.col("is_manhattan_core"))
        conditions.append(label == K.ZONE_TYPE_LABELS[kind])
    if weather is not None:
        conditions.append(_WEATHER_FILTERS[weather]())
    if day_type is not None:
        conditions.append(_DAY_FILTERS[day_type]())
    for condition in conditions:
        scored = scored.filter(condition)
    return scored


# --- Scoring ---------------------------------------------------------------


def score_demand(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Clip and round raw predictions, add errors and the zone label."""
    value = round_even(F.greatest(F.col(prediction), F.lit(0.0)), 1)
    demand = F.col("demand")
    return (
        predictions.withColumn("predicted_demand", value)
        .withColumn("error", F.col("predicted_demand") - demand)
        .withColumns(
            {
                "abs_error": F.abs("error"),
                "pct_error": F.when(
                    demand > 0, F.abs(safe_ratio(F.col("error"), demand)) * 100
                ),
                "zone_name": zone_display_name(F.col("pu_location_id")),
            }
        )
    )


def error_change(scores: DataFrame) -> DataFrame:
    """RMSE relative to the published baseline, in percent."""
    return scores.withColumn(
        "rmse_vs_paper_pct", percent_change(F.col("rmse"), F.lit(K.BASELINE_RMSE))
    )


# --- Fare and tip requests ---------------------------------------------------

_REQUEST_RANGES = {
    "pu_location_id": (1, None),
    "do_location_id": (1, None),
    "passenger_count": (1, 6),
    "ratecode_id": (1, 5),
    "hour": (0, 23),
    "day_of_week": (1, 7),
    "month": (1, 12),
    "precipitation_mm": (0, None),
    "payment_type": (1, 6),
}


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (null when the request is fine) to routed requests.

    Needs the columns of ``route_estimates``.
    """
    reason = F.lit(None).cast("string")
    checks: list[tuple[Column, str]] = []
    for name, (low, high) in _REQUEST_RANGES.items():
        bad = F.col(name).isNull() | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        checks.append((bad, f"{name} out of range"))
    checks.append((F.col("temperature_f").isNull(), "temperature_f out of range"))
    distance = F.col("trip_distance")
    checks += [
        (~F.col("can_predict") & F.col("same_zone"), "same zone"),
        (
            ~F.coalesce((distance > 0) & (distance < K.MAX_TRAIN_DISTANCE), F.lit(False)),
            "trip_distance out of range",
        ),
    ]
    reason = F.col("route_error")
    chain = F.when(reason.isNotNull(), reason)
    for bad, text in checks:
        chain = chain.when(bad, text)
    return requests.withColumn("reject_reason", chain).withColumn(
        "valid", F.col("reject_reason").isNull()
    )


def request_features(requests: DataFrame) -> DataFrame:
    """Derived flags and float casts; adds the model's inputs to each request."""
    return requests.withColumns(
        {
            "is_rush_hour": is_rush_hour(F.col("hour")),
            "is_weekend": is_weekend(F.col("day_of_week"), K.FARE_WEEKEND_DAYS),
            "is_raining": is_raining(F.col("precipitation_mm")),
            "is_cold": is_cold(F.col("temperature_f")),
            "passenger_count": F.col("passenger_count").cast("double"),
            "ratecode_id": F.col("ratecode_id").cast("double"),
        }
    )


def _settle(df: DataFrame, fare: Column, tip_pct: Column) -> DataFrame:
    """Predicted fare, tip share, tip and total, rounded to cents."""
    return (
        df.withColumns({"predicted_fare": fare, "predicted_tip_percent": tip_pct})
        .withColumn(
            "predicted_tip_amount",
            round_even(F.col("predicted_fare") * (F.col("predicted_tip_percent") / 100.0), 2),
        )
        .withColumn(
            "total_amount",
            round_even(F.col("predicted_fare") + F.col("predicted_tip_amount"), 2),
        )
    )


def fallback_fare() -> Column:
    low, high = K.FALLBACK_EVENING_HOURS
    surcharge = F.when(
        F.col("hour").between(low, high), K.FALLBACK_EVENING_SURCHARGE
    ).otherwise(0.0)
    metered = K.FALLBACK_BASE_FARE + F.col("trip_distance") * K.FALLBACK_PER_MILE
    return round_even(metered + surcharge, 2)


def fallback_tip_percent() -> Column:
    card = F.col("payment_type") == K.CARD_PAYMENT
    return F.when(card, K.FALLBACK_CARD_TIP_PERCENT).otherwise(0.0)


def fallback_fare_tip(requests: DataFrame) -> DataFrame:
    """Rule-based price for requests when no model is available."""
    return _settle(requests, fallback_fare(), fallback_tip_percent())


def score_fare_tip(
    requests: DataFrame,
    zones: DataFrame,
    *,
    fare_model=None,
    tip_model=None,
    proven_rows: int | None = None,
) -> DataFrame:
    """Route, validate and price a batch of requests.

    Rejected requests stay in the result with a reason and null predictions.  A
    missing model falls back to the rule for its part.  With a model the routed
    requests are stored once, and only the valid ones go through the trees.
    """
    routed = validate_requests(route_estimates(requests, zones, proven_rows=proven_rows))
    trained = fare_model is not None or tip_model is not None
    if trained:
        routed = materialize(routed, "routed-requests")
    every = request_features(routed)
    rows = every.filter("valid") if trained else every

    def predicted(model, column: str, fallback: Column) -> tuple[DataFrame, Column]:
        if model is None:
            return rows, fallback
        scored = model.transform(rows).withColumnRenamed("prediction", column)
        helpers = [c for c in scored.columns if c not in rows.columns and c != column]
        return scored.drop(*helpers), round_even(F.greatest(F.col(column), F.lit(0.0)), 2)

    rows, fare = predicted(fare_model, "_fare", fallback_fare())
    rows, tip = predicted(tip_model, "_tip", fallback_tip_percent())
    card = F.col("payment_type") == K.CARD_PAYMENT
    valid = F.col("valid")
    tip = F.when(F.coalesce(card, F.lit(False)), tip).otherwise(0.0)
    priced = _settle(rows, F.when(valid, fare), F.when(valid, tip)).drop("_fare", "_tip")
    if trained:
        nothing = F.lit(None).cast("double")
        priced = priced.unionByName(_settle(every.filter("NOT valid"), nothing, nothing))
    both = F.lit(fare_model is not None and tip_model is not None)
    return priced.withColumn("model_used", F.when(valid, both))
