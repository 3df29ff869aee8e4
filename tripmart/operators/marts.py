"""Pre-aggregated marts for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decimal_avg
from .joins import lookup_join
from .quantiles import exact_quantile

# Zone ids are 16-bit in every feature table, so a zone table keyed by them
# has at most this many rows.
ZONE_ID_SPACE = 65_536


def _stamped(mart: DataFrame) -> DataFrame:
    return mart.withColumn("dashboard_processed_timestamp", F.current_timestamp())


def hourly_kpi(demand: DataFrame, *, unique_key: bool = False) -> DataFrame:
    """City-wide key figures per hour.

    With ``unique_key`` the caller vouches that (zone, hour) is unique, as the
    feature build guarantees; counting rows then equals counting distinct zones
    and saves the second shuffle of a distinct aggregate.
    """
    zones = F.count("pu_location_id") if unique_key else F.count_distinct("pu_location_id")
    return _stamped(
        demand.groupBy("pickup_hour", "hour", "day_of_week", "month", "pickup_year_month").agg(
            F.sum("demand").alias("total_demand"),
            zones.cast("int").alias("active_zones"),
            F.avg("demand").alias("avg_demand_per_active_zone"),
            F.max("demand").cast("int").alias("max_zone_hour_demand"),
            F.avg("temperature_f").alias("avg_temperature_f"),
            F.avg("precipitation_mm").alias("avg_precipitation_mm"),
            F.max("gold_processed_timestamp").alias("source_gold_processed_timestamp"),
        )
    )


def pickup_zones(zones: DataFrame) -> DataFrame:
    """Zone dimension under the names the marts use, one row per 16-bit id."""
    named = zones.select(
        F.col("location_id").try_cast("smallint").alias("pu_location_id"),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
        F.col("latitude").alias("pickup_latitude"),
        F.col("longitude").alias("pickup_longitude"),
    )
    return named.filter(F.col("pu_location_id").isNotNull())


def zone_summary(demand: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone figures per month; zones are joined after aggregation.

    ``zones`` needs columns pu_location_id, pickup_borough, pickup_zone,
    pickup_latitude and pickup_longitude (see ``pickup_zones``).
    """
    summary = demand.groupBy("pickup_year_month", "pu_location_id").agg(
        F.sum("demand").alias("total_demand"),
        F.avg("demand").alias("avg_hourly_demand"),
        F.max("demand").cast("int").alias("max_hourly_demand"),
        F.count("*").cast("int").alias("active_hours"),
        F.min("pickup_hour").alias("first_pickup_hour"),
        F.max("pickup_hour").alias("last_pickup_hour"),
        F.avg("temperature_f").alias("avg_temperature_f"),
        F.avg("precipitation_mm").alias("avg_precipitation_mm"),
        F.max("gold_processed_timestamp").alias("source_gold_processed_timestamp"),
    )
    labels = ["pickup_borough", "pickup_zone", "pickup_latitude", "pickup_longitude"]
    measures = [c for c in summary.columns if c not in ("pickup_year_month", "pu_location_id")]
    joined = lookup_join(summary, zones, "pu_location_id")
    return _stamped(joined.select("pickup_year_month", "pu_location_id", *labels, *measures))


def payment_tip_summary(fare_tip: DataFrame, *, exact_median: bool = False) -> DataFrame:
    """Fare and tip figures per month and payment type (null is its own type).

    Medians are approximate by default (bounded sketch, mergeable map side);
    ``exact_median`` computes them from distributed value counts instead.
    """
    keys = ["pickup_year_month", "payment_type"]
    approx = {
        "median_tip_percent": F.percentile_approx("tip_percent", 0.5, 10000),
        "median_fare_amount": F.percentile_approx("fare_amount", 0.5, 10000),
    }
    sketches = [] if exact_median else [agg.alias(name) for name, agg in approx.items()]
    summary = fare_tip.groupBy(*keys).agg(
        F.count("*").alias("trip_count"),
        decimal_avg(F.col("fare_amount")).alias("avg_fare_amount"),
        decimal_avg(F.col("tip_amount")).alias("avg_tip_amount"),
        F.avg("tip_percent").alias("avg_tip_percent"),
        *sketches,
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.min("fare_amount").alias("min_fare_amount"),
        F.max("fare_amount").alias("max_fare_amount"),
        F.min("tip_percent").alias("min_tip_percent"),
        F.max("tip_percent").alias("max_tip_percent"),
        F.min("month").alias("month"),
        F.max("gold_processed_timestamp").alias("source_gold_processed_timestamp"),
    )
    if exact_median:
        medians = _exact_medians(fare_tip, keys)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        summary = summary.join(medians, same, "left").drop(*[f"_{k}" for k in keys])
    return _stamped(summary)


def _exact_medians(fare_tip: DataFrame, keys: list[str]) -> DataFrame:
    """Exact medians of tip share and fare per group, both in one ranking pass.

    Fares below 2^53 cents and single-precision shares are exact as doubles.
    """
    types = {name: fare_tip.schema[name].dataType for name in ("tip_percent", "fare_amount")}
    pairs = [
        F.struct(F.lit(n).alias("_measure"), F.col(n).cast("double").alias("_value"))
        for n in types
    ]
    values = fare_tip.select(*keys, F.inline(F.array(*pairs)))
    quantiles = exact_quantile(
        values, [*keys, "_measure"], "_value", 0.5, bucket=F.floor("_value")
    )
    return quantiles.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[
            F.max(F.when(F.col("_measure") == n, F.col("quantile"))).cast(t).alias(f"median_{n}")
            for n, t in types.items()
        ]
    )


def refresh_zone_names(
    mart: DataFrame, lookup: DataFrame, *, key: str = "pu_location_id"
) -> DataFrame:
    """Overwrite borough and zone from a lookup (location_id, borough, zone).

    A zone found in the lookup takes its values even when they are null; a zone
    not found keeps what it has.
    """
    # Ids beyond the mart's type match nothing; of a repeated id one row counts.
    names = (
        lookup.select(
            F.col("location_id").try_cast(mart.schema[key].dataType).alias(key),
            F.struct("borough", "zone").alias("_found"),
        )
        .groupBy(key)
        .agg(F.min("_found").alias("_found"))
    )
    found = F.col("_found").isNotNull()
    return (
        lookup_join(mart, names, key)
        .withColumns(
            {
                "pickup_borough": F.when(found, F.col("_found.borough")).otherwise(
                    F.col("pickup_borough")
                ),
                "pickup_zone": F.when(found, F.col("_found.zone")).otherwise(
                    F.col("pickup_zone")
                ),
            }
        )
        .select(*mart.columns)
    )
