"""Model features derived from the feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import (
    cyclical,
    is_airport,
    is_cold,
    is_core_zone,
    is_holiday,
    is_raining,
    is_rush_hour,
    is_weekend,
    portable_bucket,
)
from .joins import lookup_join

LAG_HOURS = (1, 2, 24, 48, 168)
REQUIRED_LAGS = [f"demand_lag{n}h" for n in LAG_HOURS] + ["demand_vmo_3day"]


def load_demand(
    demand: DataFrame, *, start: str | None = None, end: str | None = None, limit: int | None = None
) -> DataFrame:
    """Demand in ``[start, end)`` ordered by hour and zone, optionally the first rows."""
    if start is not None:
        demand = demand.filter(F.col("pickup_hour") >= F.lit(start).cast("timestamp"))
    if end is not None:
        demand = demand.filter(F.col("pickup_hour") < F.lit(end).cast("timestamp"))
    ordered = demand.orderBy("pickup_hour", "pu_location_id")
    return ordered if limit is None else ordered.limit(limit)


def _lag(offset: int, mode: str) -> Column:
    """Demand ``offset`` steps back within the zone.

    One row per zone and hour bounds a zone's window by the hours of the
    calendar, whatever share of the trips the zone has.
    """
    if mode == "row":
        return F.lag("demand", offset).over(
            Window.partitionBy("pu_location_id").orderBy("pickup_hour")
        )
    if mode == "time":
        back = -offset * 3600
        exactly = (
            Window.partitionBy("pu_location_id")
            .orderBy(F.unix_seconds(F.col("pickup_hour").cast("timestamp")))
            .rangeBetween(back, back)
        )
        return F.max("demand").over(exactly)
    raise ValueError(f"unknown lag mode {mode!r}")


def lags(demand: DataFrame, offsets: Sequence[int], mode: str = "row") -> DataFrame:
    """Add ``demand_lag<n>h`` columns.

    ``row`` counts rows of the zone, so hours without trips are skipped over;
    ``time`` looks at the hour exactly n hours earlier and is null when that hour
    had no trips.  All columns share one shuffle and one sort per zone.
    """
    return demand.withColumns({f"demand_lag{n}h": _lag(n, mode) for n in offsets})


def hourly_spine(demand: DataFrame) -> DataFrame:
    """Every zone in every hour between the first and the last: no trips are a demand of 0.

    Week-long lags then exist for any zone.  A zone has one row per hour of the calendar;
    the grid is made from the zones, and nothing is paired with anything.  Weather is the
    hour's own, where any zone knows it.
    """
    hour = F.col("pickup_hour")
    first, last = demand.agg(F.min("pickup_hour"), F.max("pickup_hour")).first()
    if first is None:
        return demand
    step = F.expr("INTERVAL 1 HOUR")
    zones = demand.select("pu_location_id").distinct()
    calendar = F.sequence(F.lit(first), F.lit(last), step)
    grid = zones.select("pu_location_id", F.explode(calendar).alias("pickup_hour"))
    weather = demand.groupBy("pickup_hour").agg(
        F.max("temperature_f").alias("temperature_f"),
        F.max("precipitation_mm").alias("precipitation_mm"),
    )
    hours = int((last - first).total_seconds()) // 3600 + 1
    known = demand.select("pu_location_id", "pickup_hour", "demand")
    filled = grid.join(known, ["pu_location_id", "pickup_hour"], "left")
    filled = lookup_join(filled, weather, "pickup_hour", proven_rows=hours)
    kinds = {f.name: f.dataType for f in demand.schema.fields}
    parts = {
        "demand": F.coalesce("demand", F.lit(0)),
        "hour": F.hour(hour),
        "day_of_week": F.dayofweek(hour),
        "month": F.month(hour),
        "pickup_year_month": F.date_format(hour, "yyyy-MM"),
    }
    names = [c for c in demand.columns if c in parts or c in filled.columns]
    return filled.select(*[parts.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in names])


def demand_features(
    demand: DataFrame,
    *,
    mode: str = "row",
    weekend_days: Sequence[int] = tuple(K.DEMAND_WEEKEND_DAYS),
    complete_only: bool = True,
) -> DataFrame:
    """The 18 derived demand features; rows without full lag history are dropped.

    ``weekend_days`` uses Sunday = 1.  The default is the published model's own
    choice; pass ``(1, 7)`` for Saturday and Sunday.
    """
    airport, core = F.col("is_airport"), F.col("is_manhattan_core")
    weekend = F.col("is_weekend")
    night = F.col("hour").isin(K.NIGHT_HOURS).cast("tinyint")
    three_days = [_lag(n, mode) for n in (24, 48, 72)]
    enriched = (
        lags(demand, LAG_HOURS, mode)
        .withColumn("demand_vmo_3day", sum(three_days[1:], three_days[0]) / F.lit(3.0))
        .withColumns(
            {
                "is_weekend": is_weekend(F.col("day_of_week"), weekend_days),
                "is_rush_hour": is_rush_hour(F.col("hour")),
                "is_cold": is_cold(F.col("temperature_f")),
                "is_raining": is_raining(F.col("precipitation_mm")),
                "is_holiday": is_holiday(F.col("pickup_hour")),
                "is_airport": is_airport(F.col("pu_location_id")),
                "is_manhattan_core": is_core_zone(F.col("pu_location_id")),
            }
        )
        .withColumns(
            {
                "is_transient_weekend_night": weekend.bitwiseAND(night),
                "airport_rush_hour": airport.bitwiseAND(F.col("is_rush_hour")),
                "manhattan_weekend": core.bitwiseAND(weekend),
                "airport_cold": airport.bitwiseAND(F.col("is_cold")),
                "manhattan_rain": core.bitwiseAND(F.col("is_raining")),
            }
        )
    )
    return enriched.dropna(subset=REQUIRED_LAGS) if complete_only else enriched


def fare_features(
    fare_tip: DataFrame, *, weekend_days: Sequence[int] = tuple(K.FARE_WEEKEND_DAYS)
) -> DataFrame:
    """Fare model rows: defaults for missing counts, training outliers removed."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    plausible = (
        (fare > 0)
        & (fare < K.MAX_TRAIN_FARE)
        & (distance > 0)
        & (distance < K.MAX_TRAIN_DISTANCE)
    )
    return (
        fare_tip.fillna({"passenger_count": 1, "ratecode_id": 1})
        .filter(plausible)
        .withColumns(
            {
                "is_weekend": is_weekend(F.col("day_of_week"), weekend_days),
                "is_rush_hour": is_rush_hour(F.col("hour")),
                "is_raining": is_raining(F.col("precipitation_mm")),
                "is_cold": is_cold(F.col("temperature_f")),
            }
        )
    )


def tip_features(fare_rows: DataFrame) -> DataFrame:
    """Card trips with a plausible tip share; cash tips are not recorded."""
    return fare_rows.filter(
        (F.col("payment_type") == K.CARD_PAYMENT) & F.col("tip_percent").between(0, 100)
    )


def hash_sample(
    df: DataFrame,
    percent: int,
    keys: Sequence[str] = ("pu_location_id", "hour", "trip_distance"),
) -> DataFrame:
    """Deterministic sample by key hash; ``percent`` is clamped to 1..100.

    Any engine draws the same rows, as the hash is one of the keys' text.  Rows with a
    null key part are never sampled.
    """
    share = max(1, min(100, int(percent)))
    known = df.dropna(subset=list(keys))
    return known.filter(portable_bucket(keys, 100) < share)


def rolling(demand: DataFrame, hours: int) -> DataFrame:
    """Mean and standard deviation of the zone's previous ``hours`` rows."""
    before = (
        Window.partitionBy("pu_location_id").orderBy("pickup_hour").rowsBetween(-hours, -1)
    )
    return demand.withColumns(
        {
            f"demand_mean_{hours}h": F.avg("demand").over(before),
            f"demand_std_{hours}h": F.stddev("demand").over(before),
        }
    )


def cyclical_features(df: DataFrame) -> DataFrame:
    """Sine/cosine encoding of hour of day and day of week."""
    encoded = {}
    for name, period in (("hour", 24), ("day_of_week", 7)):
        encoded[f"{name}_sin"], encoded[f"{name}_cos"] = cyclical(F.col(name), period)
    return df.withColumns(encoded)
