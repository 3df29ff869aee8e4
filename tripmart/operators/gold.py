"""Feature tables: demand per zone and hour, fare and tip per trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import safe_ratio, trunc_hour


def _clock_parts(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Sunday = 1) and month as bytes."""
    return {
        "hour": F.hour(ts).cast("tinyint"),
        "day_of_week": F.dayofweek(ts).cast("tinyint"),
        "month": F.month(ts).cast("tinyint"),
    }


def _contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.items()])


def candidates(core: DataFrame) -> DataFrame:
    """Trips good enough for features.

    The outlier flag must be known to be false, so a trip whose fare or total is
    missing is left out.
    """
    return core.filter("is_valid_distance AND is_valid_fare AND NOT is_outlier_trip")


def demand_features(core: DataFrame) -> DataFrame:
    """Trips per pickup zone and hour with average weather and calendar parts.

    Partial aggregation runs before the only shuffle, so a zone-hour holding a
    large part of all trips reaches its reducer as one row per map task.
    """
    hour = F.col("pickup_hour")
    demand = (
        candidates(core)
        .groupBy("pu_location_id", trunc_hour(F.col("pickup_datetime")).alias("pickup_hour"))
        .agg(
            F.count("*").alias("demand"),
            F.avg("temperature_f").alias("temperature_f"),
            F.avg("precipitation_mm").alias("precipitation_mm"),
        )
        .withColumns(_clock_parts(hour))
        .withColumns(
            {
                "pickup_year_month": F.date_format(hour, "yyyy-MM"),
                "gold_processed_timestamp": F.current_timestamp(),
            }
        )
    )
    return _contract(demand, K.DEMAND_CONTRACT)


def tip_percent() -> Column:
    """Tip as a percentage of the fare, from single-precision operands."""
    return (
        safe_ratio(F.col("tip_amount").cast("float"), F.col("fare_amount").cast("float")) * 100.0
    )


def fare_tip_features(
    core: DataFrame,
    *,
    min_fare: float = K.MIN_MODEL_FARE,
    max_fare: float = K.MAX_MODEL_FARE,
    max_tip_percent: float = K.MAX_TIP_PERCENT,
) -> DataFrame:
    """Trip-level features of plausible fares and tips; a map-only stage."""
    kept = candidates(core).filter(
        F.col("fare_amount").between(F.lit(min_fare), F.lit(max_fare))
        & (F.col("trip_distance") > 0)
        & (F.col("tip_amount") >= 0)
        & (tip_percent() <= max_tip_percent)
    )
    features = kept.withColumns(
        {
            "tip_percent": tip_percent(),
            **_clock_parts(F.col("pickup_datetime")),
            "gold_processed_timestamp": F.current_timestamp(),
        }
    )
    return _contract(features, K.FARE_TIP_CONTRACT)


def zone_hour_revenue(core: DataFrame) -> DataFrame:
    """Revenue and trip averages per pickup zone and hour."""
    return (
        candidates(core)
        .groupBy("pu_location_id", trunc_hour(F.col("pickup_datetime")).alias("pickup_hour"))
        .agg(
            F.count("*").alias("trip_count"),
            F.sum("total_amount").alias("revenue"),
            safe_ratio(F.sum("fare_amount"), F.count("fare_amount")).alias("avg_fare_amount"),
            F.avg("trip_distance").alias("avg_trip_distance"),
            F.avg("passenger_count").alias("avg_passenger_count"),
        )
    )
