"""The benchmark tables in the shapes the operators work on.

``events`` stands for trips and weather readings, ``customer`` with ``nation``
and ``region`` for zones, ``lineitem`` for trips in volume.  Every builder has a
twin among the common table expressions in ``CTES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import core as core_ops
from ..operators import features, gold, marts, silver
from ..session import materialize
from ..sources.envelopes import JSON_OPTIONS

ZONES = 263
GOLD_STAMP = "2025-01-01 00:00:00"
MART_STAMP = "2025-01-02 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Trips ------------------------------------------------------------------

_TRIP_COLUMNS = {
    "e": "event_id",
    "taxi_type": "CASE WHEN event_type IN ('click', 'view') THEN 'yellow' ELSE 'green' END",
    "vendor_id": "event_id % 2 + 1",
    "pickup": "ts",
    "dropoff": """CASE WHEN event_id % 50 = 0 THEN NULL
                       WHEN event_id % 37 = 0 THEN ts - INTERVAL 5 MINUTES
                       ELSE ts + make_dt_interval(0, 0, CAST(5 + event_id % 40 AS INT)) END""",
    "passenger_count": "CASE WHEN event_id % 20 = 0 THEN NULL ELSE event_id % 6 + 1 END",
    "trip_distance": "CAST(get_json_object(props, '$.k') AS INT) / 10.0D",
    "ratecode_id": "CASE WHEN event_id % 25 = 0 THEN NULL ELSE event_id % 5 + 1 END",
    "pu_location_id": f"CAST(user_id % {ZONES} + 1 AS INT)",
    "do_location_id": f"CAST((user_id + event_id % 3) % {ZONES} + 1 AS INT)",
    "payment_type": """CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2
                            WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END""",
    "fare_cents": "CAST(round(value * 100) AS BIGINT)",
    "tip_cents": "CAST(round(value * 100) AS BIGINT) * (event_id % 7) DIV 4",
    "congestion_surcharge": "CASE WHEN event_id % 10 = 0 THEN NULL ELSE 2.5D END",
    "airport_fee": """CASE WHEN event_type IN ('click', 'view') AND event_id % 4 <> 0
                           THEN 1.75D END""",
}


def _trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*[f"{sql} AS {name}" for name, sql in _TRIP_COLUMNS.items()])


def typed_trips(spark: SparkSession, sf_dir: str, *, once: bool = False) -> DataFrame:
    """Silver-shaped trips straight from ``events``: one per event, no JSON detour.

    With ``once`` a one-element generator keeps later filters and projections from being
    merged with these columns, which would parse and convert them again at every use; it
    works out all of them, whichever are needed.
    """
    e = F.col("e")
    rows = _trip_rows(spark, sf_dir)
    if once:
        rows = rows.select(F.inline(F.array(F.struct(*rows.columns))))
    return rows.select(
        F.concat(F.lit("nyc_taxi_"), F.col("taxi_type")).alias("topic"),
        (e % 4).cast("int").alias("partition"),
        e.alias("offset"),
        F.col("pickup").cast("timestamp").alias("kafka_timestamp"),
        "taxi_type",
        F.concat("taxi_type", F.lit("_tripdata_2024-01.parquet")).alias("source_file"),
        "vendor_id",
        F.col("pickup").cast("timestamp").alias("pickup_datetime"),
        F.col("dropoff").cast("timestamp").alias("dropoff_datetime"),
        F.date_trunc("hour", "pickup").alias("pickup_hour"),
        F.to_date("pickup").alias("pickup_date"),
        F.date_format("pickup", "yyyy-MM").alias("pickup_year_month"),
        "pu_location_id",
        "do_location_id",
        F.col("passenger_count").cast("double").alias("passenger_count"),
        "trip_distance",
        F.col("ratecode_id").cast("int").alias("ratecode_id"),
        "payment_type",
        (F.col("fare_cents") / F.lit(100.0)).alias("fare_amount"),
        ((e % 3) * F.lit(0.5)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("tip_cents") / F.lit(100.0)).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        ((F.col("fare_cents") + F.col("tip_cents")) / F.lit(100.0)).alias("total_amount"),
        "congestion_surcharge",
        "airport_fee",
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip events as JSON envelopes, with copies, mixed time formats and broken payloads.

    Every 11th event is delivered twice under its offset, every 13th is sent
    again under a new one; both copies arrive later and carry another passenger
    count, so that keeping the first arrival is visible.
    """
    rows = _trip_rows(spark, sf_dir)
    e, copy = F.col("e"), F.col("copy")
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(e % 11 == 0, 1),
            F.when(e % 13 == 0, 2),
        )
    )
    rows = rows.withColumn("copy", F.explode(copies))

    def text(ts: str):
        return (
            F.when(e % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(e % 4 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(e % 4 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        )

    yellow = F.col("taxi_type") == "yellow"
    payload = F.struct(
        F.col("vendor_id").alias("VendorID"),
        F.when(yellow, text("pickup")).alias("tpep_pickup_datetime"),
        F.when(yellow, text("dropoff")).alias("tpep_dropoff_datetime"),
        F.when(~yellow, text("pickup")).alias("lpep_pickup_datetime"),
        F.when(~yellow, text("dropoff")).alias("lpep_dropoff_datetime"),
        F.when(copy == 0, F.col("passenger_count")).otherwise(10 - copy)
        .cast("double").alias("passenger_count"),
        F.col("trip_distance"),
        F.col("ratecode_id").cast("double").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("pu_location_id").alias("PULocationID"),
        F.col("do_location_id").alias("DOLocationID"),
        F.col("payment_type").cast("double").alias("payment_type"),
        (F.col("fare_cents") / F.lit(100.0)).alias("fare_amount"),
        ((e % 3) * F.lit(0.5)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("tip_cents") / F.lit(100.0)).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        ((F.col("fare_cents") + F.col("tip_cents")) / F.lit(100.0)).alias("total_amount"),
        F.when(~yellow, e % 2 + 1).cast("double").alias("trip_type"),
        F.col("congestion_surcharge"),
        F.col("airport_fee"),
        F.col("taxi_type").alias("_taxi_type"),
        F.concat("taxi_type", F.lit("_tripdata_2024-01.parquet")).alias("_source_file"),
    )
    json = F.when(e % 97 == 13, F.lit('{"VendorID": ')).otherwise(
        F.to_json(payload, JSON_OPTIONS)
    )
    arrived = F.col("pickup") + F.make_dt_interval(hours=copy)
    return rows.select(
        F.concat(F.lit("nyc_taxi_"), F.col("taxi_type")).alias("topic"),
        (e % 4).cast("int").alias("partition"),
        F.when(copy == 2, -(e + 1)).otherwise(e).alias("offset"),
        arrived.cast("timestamp").alias("kafka_timestamp"),
        F.lit(None).cast("string").alias("key"),
        json.alias("json_data"),
        "taxi_type",
        arrived.cast("timestamp").alias("ingestion_timestamp"),
        F.date_format(arrived, "yyyy-MM-dd").alias("ingestion_date"),
    )


# --- Weather ----------------------------------------------------------------


def _moved(ts: str):
    """Times from three to four, put 60 days back: no trip finds weather for that hour."""
    return F.when(F.hour(ts) == 3, F.col(ts) - F.expr("INTERVAL 60 DAY")).otherwise(F.col(ts))


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one weather reading; those of the hour from three to four tell another day."""
    e = F.col("event_id")
    events = table(spark, sf_dir, "events")
    codes = F.array(*[F.lit(c) for c in (0, 3, 61, 99, 42)])
    payload = F.struct(
        F.date_format(_moved("ts"), "yyyy-MM-dd'T'HH:mm").alias("timestamp"),
        F.lit(40.7128).alias("latitude"),
        F.lit(-74.0060).alias("longitude"),
        F.lit("NYC_Manhattan").alias("location"),
        F.when(e % 3 != 0, 30 + F.hour("ts") + F.day("ts") % 7 + e % 3)
        .cast("double").alias("temperature_f"),
        F.when(e % 7 != 0, 40 + e % 50).cast("double").alias("humidity_percent"),
        F.when(e % 4 != 1, F.when(e % 5 == 0, 1.5).otherwise(0.0)).alias("precipitation_mm"),
        codes[(e % 5).cast("int")].alias("weather_code"),
        F.lit("from source").alias("weather_description"),
        (e % 30).cast("double").alias("wind_speed_kmh"),
        (e % 360).cast("double").alias("wind_direction_deg"),
        (e % 101).cast("double").alias("cloud_cover_percent"),
        F.lit("open_meteo").alias("_source"),
    )
    return events.select(
        F.lit("weather_stream").alias("topic"),
        (e % 2).cast("int").alias("partition"),
        e.alias("offset"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        F.to_json(payload, JSON_OPTIONS).alias("json_data"),
        F.lit("weather").alias("data_type"),
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"),
    )


def typed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour of ``events`` with values that follow from the hour."""
    h = F.col("weather_hour")
    hours = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", _moved("ts")).alias("weather_hour"))
        .agg(F.count("*").alias("readings"))
    )
    step = F.hour(h) + F.day(h)
    codes = F.array(*[F.lit(c) for c in (0, 3, 61, 99, 42)])
    return hours.select(
        h,
        h.alias("weather_timestamp"),
        F.date_format(h, "yyyy-MM-dd'T'HH:mm").alias("source_weather_timestamp"),
        F.to_date(h).alias("weather_date"),
        F.date_format(h, "yyyy-MM").alias("weather_year_month"),
        F.lit("NYC_Manhattan").alias("weather_location"),
        (30 + F.hour(h) + F.day(h) % 7).cast("double").alias("temperature_f"),
        (40 + step % 50).cast("double").alias("humidity_percent"),
        F.when(step % 5 == 0, 1.5).otherwise(0.0).alias("precipitation_mm"),
        codes[F.hour(h) % 5].alias("weather_code"),
        F.lit("typed").alias("weather_description"),
        (step % 30).cast("double").alias("wind_speed_kmh"),
        (step * 7 % 360).cast("double").alias("wind_direction_deg"),
        (step * 3 % 101).cast("double").alias("cloud_cover_percent"),
    )


# --- Zones ------------------------------------------------------------------


def zone_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: customers rolled up to at most 263 zones.

    One zone in 15 has an id that no trip uses, and another one in 15 has no latitude.
    """
    key = F.col("c_custkey") % ZONES + 1
    zone_id = F.col("location_id")
    customers = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    located = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        located.groupBy(
            F.when(key % 15 == 14, key + 1000).otherwise(key).cast("int").alias("location_id")
        )
        .agg(F.max("r_name").alias("borough"), F.max("c_name").alias("zone"))
        .select(
            "location_id",
            "borough",
            "zone",
            F.when(zone_id % 15 != 7, F.lit(40.5) + (zone_id % 50) / F.lit(100.0)).alias(
                "latitude"
            ),
            (F.lit(-74.2) + (zone_id % 37) / F.lit(100.0)).alias("longitude"),
        )
    )


# --- Layers over the typed shapes ---------------------------------------------

# The weather of these days takes part in joins, as many hours as they have.
DAYS = ("2023-01-01", "2025-01-01")


def joined_trips(spark: SparkSession, sf_dir: str, *, once: bool = False) -> DataFrame:
    return silver.join_weather(
        typed_trips(spark, sf_dir, once=once), typed_weather(spark, sf_dir), window=DAYS
    )


def core(spark: SparkSession, sf_dir: str, *, once: bool = False) -> DataFrame:
    return core_ops.build_core(joined_trips(spark, sf_dir, once=once))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_ops.build_clean(core(spark, sf_dir))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-hour demand with a lineage time that follows from the hour."""
    return gold.demand_features(core(spark, sf_dir)).withColumn(
        "gold_processed_timestamp", F.col("pickup_hour") + F.expr("INTERVAL 1 DAY")
    )


def district_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand by 25 districts, dense enough for week-long lags."""
    trips = core(spark, sf_dir).withColumn(
        "pu_location_id", ((F.col("pu_location_id") - 1) % 25 * 11 + 1).cast("smallint")
    )
    return gold.demand_features(trips).drop("gold_processed_timestamp")


def dense_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand of every zone in every hour, 0 where nobody was picked up."""
    known = demand(spark, sf_dir).drop("gold_processed_timestamp")
    return features.hourly_spine(stored(known))


def fare_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Filters and features use distance and money many times over.
    return gold.fare_tip_features(core(spark, sf_dir, once=True)).withColumn(
        "gold_processed_timestamp", F.lit(GOLD_STAMP).cast("timestamp")
    )


def _stamped(mart: DataFrame) -> DataFrame:
    return mart.withColumn("dashboard_processed_timestamp", F.lit(MART_STAMP).cast("timestamp"))


def hourly_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(marts.hourly_kpi(demand(spark, sf_dir), unique_key=True))


def zone_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = marts.pickup_zones(zone_table(spark, sf_dir))
    return _stamped(marts.zone_summary(demand(spark, sf_dir), zones))


def payment_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(marts.payment_tip_summary(fare_tip(spark, sf_dir), exact_median=True))


def stored(df: DataFrame) -> DataFrame:
    """A small table written once, for queries that read it more than once."""
    return materialize(df, "table")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with features and a stand-in prediction, scored."""
    from ..functions import is_airport, is_core_zone, is_holiday, is_weekend
    from ..operators import forecast

    rows = demand(spark, sf_dir).withColumns(
        {
            "is_airport": is_airport(F.col("pu_location_id")),
            "is_manhattan_core": is_core_zone(F.col("pu_location_id")),
            "is_holiday": is_holiday(F.col("pickup_hour")),
            "is_weekend": is_weekend(F.col("day_of_week"), [6, 7]),
            "prediction": F.col("demand") + (F.col("hour") - 12) * F.lit(0.25),
        }
    )
    return forecast.score_demand(rows).drop("prediction", "gold_processed_timestamp")


# --- SQL twins ----------------------------------------------------------------

_MOVED = "CASE WHEN hour(ts) = 3 THEN ts - INTERVAL 60 DAY ELSE ts END"

CTES = f"""
WITH trip_rows AS (
  SELECT event_id AS e, ts AS pickup,
    CASE WHEN event_type IN ('click', 'view') THEN 'yellow' ELSE 'green' END AS taxi_type,
    event_id % 2 + 1 AS vendor_id,
    CASE WHEN event_id % 50 = 0 THEN NULL
         WHEN event_id % 37 = 0 THEN ts - INTERVAL 5 MINUTE
         ELSE ts + to_minutes((5 + event_id % 40)::BIGINT) END AS dropoff,
    CASE WHEN event_id % 20 = 0 THEN NULL ELSE event_id % 6 + 1 END AS passenger_count,
    (props->>'$.k')::INT / 10.0::DOUBLE AS trip_distance,
    CASE WHEN event_id % 25 = 0 THEN NULL ELSE event_id % 5 + 1 END AS ratecode_id,
    (user_id % {ZONES} + 1)::INT AS pu_location_id,
    ((user_id + event_id % 3) % {ZONES} + 1)::INT AS do_location_id,
    CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2
         WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END AS payment_type,
    round(value * 100)::BIGINT AS fare_cents,
    round(value * 100)::BIGINT * (event_id % 7) // 4 AS tip_cents,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 2.5::DOUBLE END AS congestion_surcharge,
    CASE WHEN event_type IN ('click', 'view') AND event_id % 4 <> 0
         THEN 1.75::DOUBLE END AS airport_fee
  FROM events),
trips AS (
  SELECT 'nyc_taxi_' || taxi_type AS topic, (e % 4)::INT AS "partition", e AS "offset",
    pickup AS kafka_timestamp, taxi_type, taxi_type || '_tripdata_2024-01.parquet' AS source_file,
    vendor_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
    date_trunc('hour', pickup)::TIMESTAMP AS pickup_hour, pickup::DATE AS pickup_date,
    strftime(pickup, '%Y-%m') AS pickup_year_month, pu_location_id, do_location_id,
    passenger_count::DOUBLE AS passenger_count, trip_distance,
    ratecode_id::INT AS ratecode_id, payment_type,
    fare_cents / 100.0::DOUBLE AS fare_amount, (e % 3) * 0.5::DOUBLE AS extra,
    0.5::DOUBLE AS mta_tax, tip_cents / 100.0::DOUBLE AS tip_amount, 0.0::DOUBLE AS tolls_amount,
    1.0::DOUBLE AS improvement_surcharge,
    (fare_cents + tip_cents) / 100.0::DOUBLE AS total_amount,
    congestion_surcharge, airport_fee
  FROM trip_rows),
copies AS (
  SELECT *, unnest([0] || CASE WHEN e % 11 = 0 THEN [1] ELSE []::INT[] END
                       || CASE WHEN e % 13 = 0 THEN [2] ELSE []::INT[] END) AS copy
  FROM trip_rows),
parsed AS (
  SELECT 'nyc_taxi_' || taxi_type AS topic, (e % 4)::INT AS "partition",
    CASE WHEN copy = 2 THEN -(e + 1) ELSE e END AS "offset",
    pickup + to_hours(copy) AS kafka_timestamp, taxi_type,
    taxi_type || '_tripdata_2024-01.parquet' AS source_file, vendor_id,
    CASE e % 4 WHEN 0 THEN pickup WHEN 2 THEN date_trunc('minute', pickup)::TIMESTAMP
         ELSE date_trunc('second', pickup)::TIMESTAMP END AS pickup_datetime,
    CASE e % 4 WHEN 0 THEN dropoff WHEN 2 THEN date_trunc('minute', dropoff)::TIMESTAMP
         ELSE date_trunc('second', dropoff)::TIMESTAMP END AS dropoff_datetime,
    CASE WHEN copy = 0 THEN passenger_count ELSE 10 - copy END::DOUBLE AS passenger_count,
    trip_distance, ratecode_id::INT AS ratecode_id, pu_location_id, do_location_id, payment_type,
    fare_cents / 100.0::DOUBLE AS fare_amount, (e % 3) * 0.5::DOUBLE AS extra,
    tip_cents / 100.0::DOUBLE AS tip_amount,
    (fare_cents + tip_cents) / 100.0::DOUBLE AS total_amount,
    CASE WHEN taxi_type = 'green' THEN e % 2 + 1 END::INT AS trip_type,
    congestion_surcharge, airport_fee
  FROM copies WHERE e % 97 <> 13),
kept AS (
  SELECT * FROM parsed
  WHERE (dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime)
    AND pickup_datetime >= DATE '2023-01-01' AND pickup_datetime < DATE '2025-01-01'),
by_offset AS (
  SELECT * FROM kept QUALIFY row_number() OVER (
    PARTITION BY topic, "partition", "offset" ORDER BY kafka_timestamp) = 1),
deduped AS (
  SELECT * FROM by_offset QUALIFY row_number() OVER (
    PARTITION BY taxi_type, source_file, vendor_id, pickup_datetime, dropoff_datetime,
      pu_location_id, do_location_id, trip_distance, fare_amount, total_amount
    ORDER BY kafka_timestamp, "partition", "offset") = 1),
readings AS (
  SELECT event_id AS e, moved AS ts, date_trunc('hour', moved)::TIMESTAMP AS weather_hour,
    CASE WHEN event_id % 3 <> 0 THEN 30 + hour(seen) + day(seen) % 7 + event_id % 3 END::DOUBLE
      AS temperature_f,
    CASE WHEN event_id % 7 <> 0 THEN 40 + event_id % 50 END::DOUBLE AS humidity_percent,
    CASE WHEN event_id % 4 <> 1 THEN CASE WHEN event_id % 5 = 0 THEN 1.5 ELSE 0.0 END END::DOUBLE
      AS precipitation_mm,
    [0, 3, 61, 99, 42][event_id % 5 + 1]::INT AS weather_code,
    (event_id % 30)::DOUBLE AS wind_speed_kmh, (event_id % 360)::DOUBLE AS wind_direction_deg,
    (event_id % 101)::DOUBLE AS cloud_cover_percent
  FROM (SELECT event_id, ts AS seen, {_MOVED} AS moved FROM events)),
first_readings AS (
  SELECT weather_hour,
    (list(temperature_f ORDER BY ts, e) FILTER (temperature_f IS NOT NULL))[1] AS temperature_f,
    (list(humidity_percent ORDER BY ts, e) FILTER (humidity_percent IS NOT NULL))[1]
      AS humidity_percent,
    (list(precipitation_mm ORDER BY ts, e) FILTER (precipitation_mm IS NOT NULL))[1]
      AS precipitation_mm,
    (list(weather_code ORDER BY ts, e))[1] AS weather_code,
    (list(wind_speed_kmh ORDER BY ts, e))[1] AS wind_speed_kmh,
    (list(wind_direction_deg ORDER BY ts, e))[1] AS wind_direction_deg,
    (list(cloud_cover_percent ORDER BY ts, e))[1] AS cloud_cover_percent
  FROM readings GROUP BY weather_hour),
weather AS (
  SELECT h AS weather_hour, (30 + hour(h) + day(h) % 7)::DOUBLE AS temperature_f,
    (40 + (hour(h) + day(h)) % 50)::DOUBLE AS humidity_percent,
    CASE WHEN (hour(h) + day(h)) % 5 = 0 THEN 1.5 ELSE 0.0 END::DOUBLE AS precipitation_mm,
    [0, 3, 61, 99, 42][hour(h) % 5 + 1]::INT AS weather_code,
    ((hour(h) + day(h)) % 30)::DOUBLE AS wind_speed_kmh,
    ((hour(h) + day(h)) * 7 % 360)::DOUBLE AS wind_direction_deg,
    ((hour(h) + day(h)) * 3 % 101)::DOUBLE AS cloud_cover_percent
  FROM (SELECT DISTINCT date_trunc('hour', {_MOVED})::TIMESTAMP AS h FROM events)),
zones AS (
  SELECT location_id, borough, zone,
    CASE WHEN location_id % 15 <> 7 THEN 40.5::DOUBLE + (location_id % 50) / 100.0::DOUBLE END
      AS latitude,
    -74.2::DOUBLE + (location_id % 37) / 100.0::DOUBLE AS longitude
  FROM (SELECT (CASE WHEN (c_custkey % {ZONES} + 1) % 15 = 14 THEN 1000 ELSE 0 END
            + c_custkey % {ZONES} + 1)::INT AS location_id, max(r_name) AS borough,
          max(c_name) AS zone
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1)),
joined AS (
  SELECT t.*, w.weather_hour IS NOT NULL AS has_weather, w.weather_hour AS weather_timestamp,
    w.temperature_f, w.humidity_percent, w.precipitation_mm, w.weather_code, w.wind_speed_kmh,
    w.wind_direction_deg, w.cloud_cover_percent
  FROM trips t LEFT JOIN weather w ON t.pickup_hour = w.weather_hour),
core AS (
  SELECT taxi_type, vendor_id::TINYINT AS vendor_id, pickup_datetime, dropoff_datetime,
    pickup_hour, pickup_date, pickup_year_month, pu_location_id::SMALLINT AS pu_location_id,
    do_location_id::SMALLINT AS do_location_id, passenger_count::SMALLINT AS passenger_count,
    trip_distance::FLOAT AS trip_distance, ratecode_id::TINYINT AS ratecode_id,
    payment_type::TINYINT AS payment_type, fare_amount::DECIMAL(12, 2) AS fare_amount,
    extra::DECIMAL(12, 2) AS extra, mta_tax::DECIMAL(12, 2) AS mta_tax,
    tip_amount::DECIMAL(12, 2) AS tip_amount, tolls_amount::DECIMAL(12, 2) AS tolls_amount,
    improvement_surcharge::DECIMAL(12, 2) AS improvement_surcharge,
    total_amount::DECIMAL(12, 2) AS total_amount,
    congestion_surcharge::DECIMAL(12, 2) AS congestion_surcharge,
    airport_fee::DECIMAL(12, 2) AS airport_fee, temperature_f::FLOAT AS temperature_f,
    humidity_percent::FLOAT AS humidity_percent, precipitation_mm::FLOAT AS precipitation_mm,
    weather_code::SMALLINT AS weather_code, wind_speed_kmh::FLOAT AS wind_speed_kmh,
    wind_direction_deg::FLOAT AS wind_direction_deg,
    cloud_cover_percent::FLOAT AS cloud_cover_percent,
    coalesce(trip_distance > 0 AND trip_distance <= 100, false) AS is_valid_distance,
    coalesce(fare_amount >= 0 AND fare_amount <= 1000, false) AS is_valid_fare,
    coalesce(total_amount >= 0 AND total_amount <= 1500, false) AS is_valid_total_amount,
    NOT (trip_distance > 0 AND trip_distance <= 100)
      OR NOT (fare_amount >= 0 AND fare_amount <= 1000)
      OR NOT (total_amount >= 0 AND total_amount <= 1500) AS is_outlier_trip
  FROM joined),
clean AS (
  SELECT *, passenger_count IS NULL AS is_passenger_count_missing,
    ratecode_id IS NULL AS is_ratecode_id_missing,
    payment_type IS NULL AS is_payment_type_missing,
    congestion_surcharge IS NULL AS is_congestion_surcharge_missing,
    airport_fee IS NULL AS is_airport_fee_missing,
    coalesce(passenger_count, 1)::SMALLINT AS passenger_count_clean,
    coalesce(ratecode_id, 99)::TINYINT AS ratecode_id_clean,
    coalesce(payment_type, 0)::TINYINT AS payment_type_clean,
    coalesce(congestion_surcharge, 0)::DECIMAL(12, 2) AS congestion_surcharge_clean,
    coalesce(airport_fee, 0)::DECIMAL(12, 2) AS airport_fee_clean,
    NOT is_outlier_trip AND is_valid_distance AND is_valid_fare AND is_valid_total_amount
      AS is_gold_candidate
  FROM core
  WHERE dropoff_datetime IS NOT NULL AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL
    AND total_amount IS NOT NULL AND temperature_f IS NOT NULL),
candidates AS (
  SELECT * FROM core WHERE is_valid_distance AND is_valid_fare AND NOT is_outlier_trip),
demand AS (
  SELECT pu_location_id, date_trunc('hour', pickup_datetime)::TIMESTAMP AS pickup_hour,
    count(*)::INT AS demand, hour(any_value(pickup_hour))::TINYINT AS "hour",
    (dayofweek(any_value(pickup_hour)) + 1)::TINYINT AS day_of_week,
    month(any_value(pickup_hour))::TINYINT AS "month", avg(temperature_f)::FLOAT AS temperature_f,
    avg(precipitation_mm)::FLOAT AS precipitation_mm,
    strftime(any_value(pickup_hour), '%Y-%m') AS pickup_year_month,
    any_value(pickup_hour) + INTERVAL 1 DAY AS gold_processed_timestamp
  FROM candidates c GROUP BY 1, 2),
district_demand AS (
  SELECT ((pu_location_id - 1) % 25 * 11 + 1)::SMALLINT AS pu_location_id, pickup_hour,
    count(*)::INT AS demand, hour(pickup_hour)::TINYINT AS "hour",
    (dayofweek(pickup_hour) + 1)::TINYINT AS day_of_week, month(pickup_hour)::TINYINT AS "month",
    avg(temperature_f)::FLOAT AS temperature_f, avg(precipitation_mm)::FLOAT AS precipitation_mm,
    strftime(pickup_hour, '%Y-%m') AS pickup_year_month
  FROM candidates GROUP BY 1, 2),
hours AS (
  SELECT t AS pickup_hour, max(temperature_f) AS temperature_f,
    max(precipitation_mm) AS precipitation_mm
  FROM (SELECT unnest(generate_series(min(pickup_hour), max(pickup_hour), INTERVAL 1 HOUR)) AS t
        FROM demand) LEFT JOIN demand ON pickup_hour = t GROUP BY 1),
dense_demand AS (
  SELECT z.pu_location_id, h.pickup_hour, coalesce(d.demand, 0)::INT AS demand,
    hour(h.pickup_hour)::TINYINT AS "hour", (dayofweek(h.pickup_hour) + 1)::TINYINT AS day_of_week,
    month(h.pickup_hour)::TINYINT AS "month", h.temperature_f, h.precipitation_mm,
    strftime(h.pickup_hour, '%Y-%m') AS pickup_year_month
  FROM (SELECT DISTINCT pu_location_id FROM demand) z CROSS JOIN hours h
  LEFT JOIN demand d ON d.pu_location_id = z.pu_location_id AND d.pickup_hour = h.pickup_hour),
tipped AS (
  SELECT *, (tip_amount::FLOAT::DOUBLE / nullif(fare_amount::FLOAT::DOUBLE, 0)) * 100.0::DOUBLE
    AS pct
  FROM candidates),
fare_tip AS (
  SELECT fare_amount, tip_amount, pct::FLOAT AS tip_percent, trip_distance, pu_location_id,
    do_location_id, passenger_count, ratecode_id, payment_type,
    hour(pickup_datetime)::TINYINT AS "hour",
    (dayofweek(pickup_datetime) + 1)::TINYINT AS day_of_week,
    month(pickup_datetime)::TINYINT AS "month", temperature_f, precipitation_mm,
    pickup_year_month, TIMESTAMP '{GOLD_STAMP}' AS gold_processed_timestamp
  FROM tipped
  WHERE fare_amount >= 2.5 AND fare_amount <= 300 AND trip_distance > 0 AND tip_amount >= 0
    AND pct <= 100),
hourly_mart AS (
  SELECT pickup_hour, "hour", day_of_week, "month", pickup_year_month,
    sum(demand)::BIGINT AS total_demand, count(DISTINCT pu_location_id)::INT AS active_zones,
    avg(demand) AS avg_demand_per_active_zone, max(demand)::INT AS max_zone_hour_demand,
    avg(temperature_f) AS avg_temperature_f, avg(precipitation_mm) AS avg_precipitation_mm,
    max(gold_processed_timestamp) AS source_gold_processed_timestamp,
    TIMESTAMP '{MART_STAMP}' AS dashboard_processed_timestamp
  FROM demand GROUP BY ALL),
zone_mart AS (
  SELECT pickup_year_month, pu_location_id, borough AS pickup_borough, zone AS pickup_zone,
    latitude AS pickup_latitude, longitude AS pickup_longitude, total_demand, avg_hourly_demand,
    max_hourly_demand, active_hours, first_pickup_hour, last_pickup_hour, avg_temperature_f,
    avg_precipitation_mm, source_gold_processed_timestamp,
    TIMESTAMP '{MART_STAMP}' AS dashboard_processed_timestamp
  FROM (SELECT pickup_year_month, pu_location_id, sum(demand)::BIGINT AS total_demand,
          avg(demand) AS avg_hourly_demand, max(demand)::INT AS max_hourly_demand,
          count(*)::INT AS active_hours, min(pickup_hour) AS first_pickup_hour,
          max(pickup_hour) AS last_pickup_hour, avg(temperature_f) AS avg_temperature_f,
          avg(precipitation_mm) AS avg_precipitation_mm,
          max(gold_processed_timestamp) AS source_gold_processed_timestamp
        FROM demand GROUP BY 1, 2) d
  LEFT JOIN zones ON location_id = pu_location_id),
payment_mart AS (
  SELECT pickup_year_month, payment_type, count(*) AS trip_count,
    sum(fare_amount)::DOUBLE / count(*) AS avg_fare_amount,
    sum(tip_amount)::DOUBLE / count(*) AS avg_tip_amount, avg(tip_percent) AS avg_tip_percent,
    quantile_disc(tip_percent, 0.5) AS median_tip_percent,
    quantile_disc(fare_amount, 0.5) AS median_fare_amount,
    avg(trip_distance) AS avg_trip_distance, min(fare_amount) AS min_fare_amount,
    max(fare_amount) AS max_fare_amount, min(tip_percent) AS min_tip_percent,
    max(tip_percent) AS max_tip_percent, min("month") AS "month",
    max(gold_processed_timestamp) AS source_gold_processed_timestamp,
    TIMESTAMP '{MART_STAMP}' AS dashboard_processed_timestamp
  FROM fare_tip GROUP BY 1, 2),
scored AS (
  SELECT d.* EXCLUDE (gold_processed_timestamp),
    (pu_location_id IN (1, 132, 138))::TINYINT AS is_airport,
    (pu_location_id IN (50, 68, 90, 100, 107, 113, 114, 142, 148, 158, 161, 162, 163, 164, 166,
      167, 168, 170, 186, 187, 188, 209, 211, 224)
      OR pu_location_id BETWEEN 230 AND 263)::TINYINT AS is_manhattan_core,
    (pickup_hour::DATE IN (DATE '2024-01-01', DATE '2024-01-15'))::TINYINT AS is_holiday,
    (day_of_week IN (6, 7))::TINYINT AS is_weekend, p AS predicted_demand,
    p - demand AS error, abs(p - demand) AS abs_error,
    CASE WHEN demand > 0 THEN abs((p - demand) / demand) * 100 END AS pct_error,
    CASE pu_location_id WHEN 1 THEN 'Newark Airport' WHEN 48 THEN 'Clinton East'
      WHEN 87 THEN 'Financial District N' WHEN 88 THEN 'Financial District S'
      WHEN 132 THEN 'JFK Airport' WHEN 138 THEN 'LaGuardia Airport'
      WHEN 161 THEN 'Midtown Center' WHEN 162 THEN 'Midtown East' WHEN 163 THEN 'Midtown North'
      WHEN 170 THEN 'Murray Hill' WHEN 186 THEN 'Penn Station'
      WHEN 230 THEN 'Times Sq/Theatre District' WHEN 234 THEN 'Union Square'
      WHEN 236 THEN 'Upper East Side N' WHEN 237 THEN 'Upper East Side S'
      ELSE 'Zone ' || pu_location_id END AS zone_name
  FROM (SELECT *, round_even(greatest(demand + ("hour" - 12) * 0.25::DOUBLE, 0.0) * 10, 0) / 10 AS p
        FROM demand) d)
"""
