"""Feature tables and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, gold, marts, silver
from ..operators import core as core_ops
from . import shapes
from .registry import query


@query(
    "gold_candidates",
    """
    SELECT taxi_type, pickup_datetime, pu_location_id, trip_distance, fare_amount, total_amount
    FROM candidates
    """,
)
def _(spark, sf_dir):
    return gold.candidates(shapes.core(spark, sf_dir)).select(
        "taxi_type", "pickup_datetime", "pu_location_id", "trip_distance", "fare_amount",
        "total_amount",
    )


@query("demand_by_zone_hour", "SELECT * EXCLUDE (gold_processed_timestamp) FROM demand")
def _(spark, sf_dir):
    return gold.demand_features(shapes.core(spark, sf_dir)).drop("gold_processed_timestamp")


@query("fare_tip_features", "SELECT * EXCLUDE (gold_processed_timestamp) FROM fare_tip")
def _(spark, sf_dir):
    return shapes.fare_tip(spark, sf_dir).drop("gold_processed_timestamp")


@query(
    "zone_hour_revenue",
    """
    SELECT pu_location_id, pickup_hour, count(*) AS trip_count,
      sum(total_amount)::DECIMAL(22, 2) AS revenue,
      sum(fare_amount)::DOUBLE / count(fare_amount) AS avg_fare_amount,
      avg(trip_distance) AS avg_trip_distance, avg(passenger_count) AS avg_passenger_count
    FROM candidates GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    return gold.zone_hour_revenue(shapes.core(spark, sf_dir))


@query("hourly_kpi", "SELECT * FROM hourly_mart")
def _(spark, sf_dir):
    mart = marts.hourly_kpi(shapes.demand(spark, sf_dir))
    return mart.withColumn(
        "dashboard_processed_timestamp", F.lit(shapes.MART_STAMP).cast("timestamp")
    )


@query("hourly_kpi_unique_key", "SELECT * FROM hourly_mart")
def _(spark, sf_dir):
    return shapes.hourly_mart(spark, sf_dir)


@query("zone_summary", "SELECT * FROM zone_mart")
def _(spark, sf_dir):
    return shapes.zone_mart(spark, sf_dir)


@query("payment_tip_summary", "SELECT * FROM payment_mart")
def _(spark, sf_dir):
    return shapes.payment_mart(spark, sf_dir)


@query(
    "payment_sketch_error",
    """
    SELECT pickup_year_month, payment_type, trip_count, true AS fare_within_bound,
      true AS tip_within_bound
    FROM payment_mart
    """,
)
def _(spark, sf_dir):
    """Rank error of the sketched medians: at most one in 10,000 rows of the group."""
    rows = shapes.stored(shapes.fare_tip(spark, sf_dir))
    keys = ["pickup_year_month", "payment_type"]
    sketched = marts.payment_tip_summary(rows).select(
        *[F.col(k).alias(f"_{k}") for k in keys], "trip_count", "median_fare_amount",
        "median_tip_percent",
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = rows.join(sketched, same)

    def within(value: str, median: str):
        middle = F.col("trip_count") / 2
        slack = F.col("trip_count") / 10_000 + 1
        below = F.count_if(F.col(value) < F.col(median))
        upto = F.count_if(F.col(value) <= F.col(median))
        return F.max((middle + slack)) >= below, F.max(middle - slack) <= upto

    fare, tip = within("fare_amount", "median_fare_amount"), within("tip_percent", "median_tip_percent")
    return joined.groupBy(*keys).agg(
        F.max("trip_count").alias("trip_count"),
        (fare[0] & fare[1]).alias("fare_within_bound"),
        (tip[0] & tip[1]).alias("tip_within_bound"),
    )


@query("payment_tip_summary_exact", "SELECT * FROM payment_mart")
def _(spark, sf_dir):
    mart = marts.payment_tip_summary(shapes.fare_tip(spark, sf_dir), exact_median=True)
    return mart.withColumn(
        "dashboard_processed_timestamp", F.lit(shapes.MART_STAMP).cast("timestamp")
    )


@query(
    "refresh_zone_names",
    """
    SELECT m.pickup_year_month, m.pu_location_id,
      CASE WHEN z.location_id IS NULL THEN m.pickup_borough ELSE z.borough END AS pickup_borough,
      CASE WHEN z.location_id IS NULL THEN m.pickup_zone ELSE z.zone END AS pickup_zone,
      m.total_demand
    FROM zone_mart m LEFT JOIN (
      SELECT location_id, CASE WHEN location_id % 4 = 0 THEN NULL ELSE upper(borough) END AS borough,
        zone || ' (new)' AS zone
      FROM zones WHERE location_id % 3 = 0) z ON z.location_id = m.pu_location_id
    """,
)
def _(spark, sf_dir):
    zone_id = F.col("location_id")
    lookup = (
        shapes.zone_table(spark, sf_dir)
        .filter(zone_id % 3 == 0)
        .select(
            "location_id",
            F.when(zone_id % 4 != 0, F.upper("borough")).alias("borough"),
            F.concat("zone", F.lit(" (new)")).alias("zone"),
        )
    )
    return marts.refresh_zone_names(shapes.zone_mart(spark, sf_dir), lookup).select(
        "pickup_year_month", "pu_location_id", "pickup_borough", "pickup_zone", "total_demand"
    )


@query(
    "zone_demand_from_json",
    """
    SELECT pu_location_id, pickup_hour, count(*)::INT AS demand,
      avg(temperature_f::FLOAT)::FLOAT AS temperature_f
    FROM (
      SELECT d.pu_location_id::SMALLINT AS pu_location_id,
        date_trunc('hour', d.pickup_datetime)::TIMESTAMP AS pickup_hour, w.temperature_f
      FROM deduped d LEFT JOIN first_readings w
        ON date_trunc('hour', d.pickup_datetime)::TIMESTAMP = w.weather_hour
      WHERE trip_distance > 0 AND trip_distance <= 100 AND fare_amount BETWEEN 0 AND 1000
        AND total_amount BETWEEN 0 AND 1500)
    GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    """Envelopes to demand features in one plan: parse, dedup, join, flag, aggregate."""
    trips = silver.normalize_trips(silver.parse_trips(shapes.bronze_trips(spark, sf_dir)))
    readings = silver.normalize_weather(
        silver.parse_weather(shapes.bronze_weather(spark, sf_dir))
    )
    joined = silver.join_weather(
        trips, silver.hourly_weather(readings), window=shapes.DAYS
    )
    return gold.demand_features(core_ops.build_core(joined)).select(
        "pu_location_id", "pickup_hour", "demand", "temperature_f"
    )


# --- Model features ---------------------------------------------------------------

_LAG_ROW = "lag(demand, {n}) OVER (PARTITION BY pu_location_id ORDER BY pickup_hour)"


@query(
    "demand_lags_row",
    f"""
    SELECT pu_location_id, pickup_hour, demand,
      {", ".join(f'{_LAG_ROW.format(n=n)} AS demand_lag{n}h' for n in (1, 2, 3, 6, 24, 48, 168))}
    FROM district_demand
    """,
)
def _(spark, sf_dir):
    demand = shapes.district_demand(spark, sf_dir).select(
        "pu_location_id", "pickup_hour", "demand"
    )
    return features.lags(demand, (1, 2, 3, 6, 24, 48, 168), "row")


@query(
    "demand_lags_time",
    f"""
    SELECT d.pu_location_id, d.pickup_hour, d.demand,
      {", ".join(f'l{n}.demand AS demand_lag{n}h' for n in (1, 2, 24, 48, 168))}
    FROM district_demand d
    {" ".join(
        f"LEFT JOIN district_demand l{n} ON l{n}.pu_location_id = d.pu_location_id "
        f"AND l{n}.pickup_hour = d.pickup_hour - INTERVAL {n} HOUR"
        for n in (1, 2, 24, 48, 168))}
    """,
)
def _(spark, sf_dir):
    demand = shapes.district_demand(spark, sf_dir).select(
        "pu_location_id", "pickup_hour", "demand"
    )
    return features.lags(demand, features.LAG_HOURS, "time")


@query(
    "demand_features",
    f"""
    SELECT *, weekend & ("hour" IN (0, 1, 2, 3, 4))::TINYINT AS is_transient_weekend_night,
      weekend AS is_weekend, rush AS is_rush_hour, cold AS is_cold, rain AS is_raining,
      airport AS is_airport, core AS is_manhattan_core, airport & rush AS airport_rush_hour,
      core & weekend AS manhattan_weekend, airport & cold AS airport_cold,
      core & rain AS manhattan_rain
    FROM (
      SELECT *, {", ".join(f'{_LAG_ROW.format(n=n)} AS demand_lag{n}h'
                           for n in (1, 2, 24, 48, 168))},
        ({" + ".join(_LAG_ROW.format(n=n) for n in (24, 48, 72))}) / 3.0::DOUBLE
          AS demand_vmo_3day,
        (day_of_week IN (6, 7))::TINYINT AS weekend,
        ("hour" IN (7, 8, 9, 17, 18, 19))::TINYINT AS rush,
        coalesce(temperature_f < 36, false)::TINYINT AS cold,
        coalesce(precipitation_mm > 0, false)::TINYINT AS rain,
        (pickup_hour::DATE IN (DATE '2024-01-01', DATE '2024-01-15'))::TINYINT AS is_holiday,
        (pu_location_id IN (1, 132, 138))::TINYINT AS airport,
        (pu_location_id IN (100, 166, 188, 232, 243, 254))::TINYINT AS core
      FROM district_demand)
    WHERE demand_lag168h IS NOT NULL
    """,
)
def _(spark, sf_dir):
    rows = features.demand_features(shapes.district_demand(spark, sf_dir))
    return rows.withColumns(
        {
            "weekend": F.col("is_weekend"),
            "rush": F.col("is_rush_hour"),
            "cold": F.col("is_cold"),
            "rain": F.col("is_raining"),
            "airport": F.col("is_airport"),
            "core": F.col("is_manhattan_core"),
        }
    )


_FARE_SQL = """
    SELECT fare_amount, tip_amount, tip_percent, trip_distance, pu_location_id, do_location_id,
      coalesce(passenger_count, 1)::SMALLINT AS passenger_count,
      coalesce(ratecode_id, 1)::TINYINT AS ratecode_id, payment_type, "hour", day_of_week,
      "month", temperature_f, precipitation_mm,
      (day_of_week IN (5, 6))::TINYINT AS is_weekend,
      ("hour" IN (7, 8, 9, 17, 18, 19))::TINYINT AS is_rush_hour,
      coalesce(precipitation_mm > 0, false)::TINYINT AS is_raining,
      coalesce(temperature_f < 36, false)::TINYINT AS is_cold
    FROM fare_tip WHERE fare_amount > 0 AND fare_amount < 500 AND trip_distance > 0
      AND trip_distance < 150
"""
_NOT_COMPARED = ("pickup_year_month", "gold_processed_timestamp")


@query("fare_features", _FARE_SQL)
def _(spark, sf_dir):
    return features.fare_features(shapes.fare_tip(spark, sf_dir)).drop(*_NOT_COMPARED)


@query(
    "tip_features", f"SELECT * FROM ({_FARE_SQL}) WHERE payment_type = 1 AND tip_percent <= 100"
)
def _(spark, sf_dir):
    rows = features.fare_features(shapes.fare_tip(spark, sf_dir))
    return features.tip_features(rows).drop(*_NOT_COMPARED)


@query(
    "hash_sample",
    """
    SELECT * EXCLUDE (gold_processed_timestamp) FROM fare_tip
    WHERE ('0x' || left(md5('|' || pu_location_id || '|' || "hour" || '|' || trip_distance), 8))
      ::BIGINT % 100 < 20
    """,
)
def _(spark, sf_dir):
    rows = features.hash_sample(shapes.fare_tip(spark, sf_dir), 20)
    return rows.drop("gold_processed_timestamp")


@query(
    "load_demand",
    """
    SELECT pu_location_id, pickup_hour, demand FROM demand
    WHERE pickup_hour >= TIMESTAMP '2024-01-08' AND pickup_hour < TIMESTAMP '2024-01-22'
    """,
)
def _(spark, sf_dir):
    rows = features.load_demand(
        shapes.demand(spark, sf_dir), start="2024-01-08", end="2024-01-22"
    )
    return rows.select("pu_location_id", "pickup_hour", "demand")


@query(
    "rolling_demand",
    """
    SELECT pu_location_id, pickup_hour, demand, avg(demand) OVER w AS demand_mean_24h,
      round(stddev_samp(demand) OVER w, 6) AS demand_std_24h
    FROM district_demand WINDOW w AS (PARTITION BY pu_location_id ORDER BY pickup_hour
      ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
    """,
)
def _(spark, sf_dir):
    rows = features.rolling(shapes.district_demand(spark, sf_dir), 24)
    return rows.select(
        "pu_location_id", "pickup_hour", "demand", "demand_mean_24h",
        F.round("demand_std_24h", 6).alias("demand_std_24h"),
    )


@query(
    "cyclical_features",
    """
    SELECT pu_location_id, pickup_hour, round(sin(2 * pi() * "hour" / 24), 6) AS hour_sin,
      round(cos(2 * pi() * "hour" / 24), 6) AS hour_cos,
      round(sin(2 * pi() * day_of_week / 7), 6) AS day_of_week_sin,
      round(cos(2 * pi() * day_of_week / 7), 6) AS day_of_week_cos
    FROM demand
    """,
)
def _(spark, sf_dir):
    rows = features.cyclical_features(shapes.demand(spark, sf_dir))
    encoded = ["hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos"]
    return rows.select(
        "pu_location_id", "pickup_hour", *[F.round(c, 6).alias(c) for c in encoded]
    )
