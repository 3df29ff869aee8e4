"""Envelope, Silver, Core and Clean queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse_local_ts, weather_description
from ..operators import core as core_ops
from ..operators import joins, silver
from ..sources.envelopes import JSON_OPTIONS, explode_weather
from . import shapes
from .registry import query

# --- Parsing ----------------------------------------------------------------

_PARSED = [
    "topic", "partition", "offset", "kafka_timestamp", "taxi_type", "source_file", "vendor_id",
    "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "ratecode_id",
    "pu_location_id", "do_location_id", "payment_type", "fare_amount", "extra", "tip_amount",
    "total_amount", "trip_type", "congestion_surcharge", "airport_fee",
]
_PARSED_SQL = ", ".join(f'"{c}"' for c in _PARSED)


def _parsed(spark, sf_dir, kind):
    bronze = shapes.bronze_trips(spark, sf_dir)
    if kind != "auto":
        bronze = bronze.filter(F.col("taxi_type") == kind)
    typed = silver.type_trips(silver.parse_trips(bronze, kind))
    return typed.dropna(subset=["pickup_datetime"]).select(*_PARSED)


@query("parse_yellow", f"SELECT {_PARSED_SQL} FROM parsed WHERE taxi_type = 'yellow'")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir, "yellow")


@query("parse_green", f"SELECT {_PARSED_SQL} FROM parsed WHERE taxi_type = 'green'")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir, "green")


@query("parse_mixed", f"SELECT {_PARSED_SQL} FROM parsed")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir, "auto")


@query(
    "parse_timestamps",
    """
    SELECT e, pickup AS micros, date_trunc('second', pickup)::TIMESTAMP AS seconds,
      date_trunc('minute', pickup)::TIMESTAMP AS minutes, NULL::TIMESTAMP AS unreadable
    FROM trip_rows
    """,
)
def _(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events")
    text = events.select(
        F.col("event_id").alias("e"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("seconds"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("minutes"),
        F.concat(F.lit("on "), F.date_format("ts", "d MMM")).alias("unreadable"),
    )
    return text.withColumns({c: parse_local_ts(F.col(c)) for c in text.columns if c != "e"})


@query(
    "time_parts",
    """
    SELECT topic, "offset", pickup_datetime,
      date_trunc('hour', pickup_datetime)::TIMESTAMP AS pickup_hour,
      pickup_datetime::DATE AS pickup_date,
      strftime(pickup_datetime, '%Y-%m') AS pickup_year_month
    FROM parsed
    """,
)
def _(spark, sf_dir):
    typed = silver.type_trips(silver.parse_trips(shapes.bronze_trips(spark, sf_dir)))
    return typed.dropna(subset=["pickup_datetime"]).select(
        "topic", "offset", "pickup_datetime", "pickup_hour", "pickup_date", "pickup_year_month"
    )


# --- Row filters ------------------------------------------------------------


@query(
    "time_order_filter",
    """
    SELECT "offset", taxi_type, pickup_datetime, dropoff_datetime FROM trips
    WHERE dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime
    """,
)
def _(spark, sf_dir):
    kept = silver.ordered_times(shapes.typed_trips(spark, sf_dir))
    return kept.select("offset", "taxi_type", "pickup_datetime", "dropoff_datetime")


@query(
    "date_window",
    """
    SELECT pickup_date, count(*) AS trip_count FROM trips
    WHERE pickup_date >= DATE '2024-01-05' AND pickup_date < DATE '2024-01-20'
    GROUP BY pickup_date
    """,
)
def _(spark, sf_dir):
    rows = silver.in_window(
        shapes.typed_trips(spark, sf_dir), "pickup_date", "2024-01-05", "2024-01-20"
    )
    return rows.groupBy("pickup_date").agg(F.count("*").alias("trip_count"))


# --- Deduplication ------------------------------------------------------------

_KEPT = [
    "topic", "partition", "offset", "kafka_timestamp", "taxi_type", "pickup_datetime",
    "pu_location_id", "passenger_count", "fare_amount",
]
_KEPT_SQL = ", ".join(f'"{c}"' for c in _KEPT)


def _normalized(spark, sf_dir, dedup):
    parsed = silver.parse_trips(shapes.bronze_trips(spark, sf_dir))
    return silver.normalize_trips(parsed, dedup=dedup)


@query("dedup_transport", f"SELECT {_KEPT_SQL} FROM by_offset")
def _(spark, sf_dir):
    return silver.dedup_transport(_normalized(spark, sf_dir, False)).select(*_KEPT)


@query(
    "dedup_business",
    f"""
    SELECT {_KEPT_SQL} FROM kept QUALIFY row_number() OVER (
      PARTITION BY taxi_type, source_file, vendor_id, pickup_datetime, dropoff_datetime,
        pu_location_id, do_location_id, trip_distance, fare_amount, total_amount
      ORDER BY kafka_timestamp, "partition", "offset") = 1
    """,
)
def _(spark, sf_dir):
    return silver.dedup_business(_normalized(spark, sf_dir, False)).select(*_KEPT)


@query("normalize_trips", f"SELECT {_PARSED_SQL} FROM deduped")
def _(spark, sf_dir):
    return _normalized(spark, sf_dir, True).select(*_PARSED)


@query(
    "union_by_name",
    """
    SELECT taxi_type, count(*) AS trip_count, count(trip_type) AS with_trip_type,
      count(airport_fee) AS with_airport_fee
    FROM parsed GROUP BY taxi_type
    """,
)
def _(spark, sf_dir):
    bronze = shapes.bronze_trips(spark, sf_dir)
    parts = []
    for kind, absent in (("yellow", "trip_type"), ("green", "airport_fee")):
        one = silver.parse_trips(bronze.filter(F.col("taxi_type") == kind), kind)
        parts.append(silver.type_trips(one).dropna(subset=["pickup_datetime"]).drop(absent))
    union = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return union.groupBy("taxi_type").agg(
        F.count("*").alias("trip_count"),
        F.count("trip_type").alias("with_trip_type"),
        F.count("airport_fee").alias("with_airport_fee"),
    )


# --- Weather ------------------------------------------------------------------

_WEATHER = [
    "weather_hour", "temperature_f", "humidity_percent", "precipitation_mm", "weather_code",
    "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent",
]


def _readings(spark, sf_dir):
    return silver.normalize_weather(silver.parse_weather(shapes.bronze_weather(spark, sf_dir)))


@query(
    "parse_weather",
    """
    SELECT e AS "offset", date_trunc('minute', ts)::TIMESTAMP AS weather_timestamp,
      weather_hour, temperature_f, humidity_percent, precipitation_mm, weather_code,
      wind_speed_kmh, wind_direction_deg, cloud_cover_percent
    FROM readings
    """,
)
def _(spark, sf_dir):
    return _readings(spark, sf_dir).select("offset", "weather_timestamp", *_WEATHER)


@query("hourly_weather", "SELECT * FROM first_readings")
def _(spark, sf_dir):
    return silver.hourly_weather(_readings(spark, sf_dir)).select(*_WEATHER)


@query(
    "hourly_weather_first_row",
    """
    SELECT weather_hour, temperature_f, humidity_percent, precipitation_mm, weather_code,
      wind_speed_kmh, wind_direction_deg, cloud_cover_percent
    FROM readings QUALIFY row_number() OVER (PARTITION BY weather_hour ORDER BY ts, e % 2, e) = 1
    """,
)
def _(spark, sf_dir):
    return silver.hourly_weather(_readings(spark, sf_dir), "first_row").select(*_WEATHER)


@query(
    "weather_explode",
    """
    SELECT strftime(weather_hour, '%Y-%m-%dT%H:%M') AS "timestamp", temperature_f, weather_code,
      CASE weather_code WHEN 0 THEN 'Clear sky' WHEN 3 THEN 'Overcast' WHEN 61 THEN 'Slight rain'
        WHEN 99 THEN 'Thunderstorm with heavy hail' ELSE 'Unknown' END AS weather_description,
      precipitation_mm, 'NYC_Manhattan' AS "location", 'open_meteo' AS _source
    FROM weather
    """,
)
def _(spark, sf_dir):
    hours = shapes.typed_weather(spark, sf_dir)
    # One response per day with parallel hourly arrays, as the weather service sends it.
    entry = F.sort_array(
        F.collect_list(
            F.struct("weather_hour", "temperature_f", "precipitation_mm", "weather_code")
        )
    )
    days = hours.groupBy("weather_date").agg(entry.alias("h"))
    arrays = F.struct(
        F.transform("h.weather_hour", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm")).alias(
            "time"
        ),
        F.col("h.temperature_f").alias("temperature_2m"),
        F.col("h.precipitation_mm").alias("precipitation"),
        F.col("h.weather_code").alias("weather_code"),
    )
    body = F.to_json(F.struct(arrays.alias("hourly")), JSON_OPTIONS)
    return explode_weather(days.select(body.alias("body"))).select(
        "timestamp", "temperature_f", "weather_code", "weather_description", "precipitation_mm",
        "location", "_source",
    )


@query(
    "weather_description",
    """
    SELECT code, CASE code WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Mainly clear'
        WHEN 2 THEN 'Partly cloudy' WHEN 3 THEN 'Overcast' WHEN 45 THEN 'Foggy'
        WHEN 48 THEN 'Depositing rime fog' WHEN 51 THEN 'Light drizzle'
        WHEN 53 THEN 'Moderate drizzle' WHEN 55 THEN 'Dense drizzle' WHEN 61 THEN 'Slight rain'
        WHEN 63 THEN 'Moderate rain' WHEN 65 THEN 'Heavy rain' WHEN 71 THEN 'Slight snow'
        WHEN 73 THEN 'Moderate snow' WHEN 75 THEN 'Heavy snow' WHEN 77 THEN 'Snow grains'
        WHEN 80 THEN 'Slight rain showers' WHEN 81 THEN 'Moderate rain showers'
        WHEN 82 THEN 'Violent rain showers' WHEN 85 THEN 'Slight snow showers'
        WHEN 86 THEN 'Heavy snow showers' WHEN 95 THEN 'Thunderstorm'
        WHEN 96 THEN 'Thunderstorm with slight hail' WHEN 99 THEN 'Thunderstorm with heavy hail'
        ELSE CASE WHEN code IS NOT NULL THEN 'Unknown' END END AS description,
      count(*) AS reading_count
    FROM (SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id % 101 END::INT AS code
          FROM events) GROUP BY code
    """,
)
def _(spark, sf_dir):
    e = F.col("event_id")
    code = F.when(e % 50 != 0, e % 101).cast("int").alias("code")
    counted = (
        shapes.table(spark, sf_dir, "events")
        .groupBy(code)
        .agg(F.count("*").alias("reading_count"))
    )
    return counted.withColumn("description", weather_description(F.col("code")))


# --- Joins ----------------------------------------------------------------------


@query(
    "trips_weather_join",
    """
    SELECT "offset", taxi_type, pickup_datetime, pickup_hour, weather_timestamp, temperature_f,
      precipitation_mm, weather_code FROM joined
    """,
)
def _(spark, sf_dir):
    return shapes.joined_trips(spark, sf_dir).select(
        "offset", "taxi_type", "pickup_datetime", "pickup_hour", "weather_timestamp",
        "temperature_f", "precipitation_mm", "weather_code",
    )


@query(
    "trips_zone_join",
    """
    SELECT "offset", pu_location_id, do_location_id, p.borough AS pickup_zone_borough,
      p.zone AS pickup_zone_name, p.latitude AS pickup_zone_lat, p.longitude AS pickup_zone_lon,
      d.borough AS dropoff_zone_borough, d.zone AS dropoff_zone_name,
      d.latitude AS dropoff_zone_lat, d.longitude AS dropoff_zone_lon
    FROM trips LEFT JOIN zones p ON pu_location_id = p.location_id
    LEFT JOIN zones d ON do_location_id = d.location_id
    """,
)
def _(spark, sf_dir):
    trips = shapes.typed_trips(spark, sf_dir).select("offset", "pu_location_id", "do_location_id")
    return joins.join_zones(
        trips, shapes.zone_table(spark, sf_dir), proven_rows=shapes.ZONES
    )


@query(
    "silver_from_json",
    """
    SELECT d.taxi_type, d."offset", d.pickup_datetime, d.pu_location_id, d.fare_amount,
      w.temperature_f, w.precipitation_mm
    FROM deduped d LEFT JOIN first_readings w
      ON date_trunc('hour', d.pickup_datetime)::TIMESTAMP = w.weather_hour
    """,
)
def _(spark, sf_dir):
    trips = _normalized(spark, sf_dir, True)
    weather = silver.hourly_weather(_readings(spark, sf_dir))
    joined = silver.join_weather(trips, weather, window=shapes.DAYS)
    return joined.select(
        "taxi_type", "offset", "pickup_datetime", "pu_location_id", "fare_amount",
        "temperature_f", "precipitation_mm",
    )


# --- Core and Clean ------------------------------------------------------------------


@query("core_table", "SELECT * FROM core")
def _(spark, sf_dir):
    return shapes.core(spark, sf_dir).drop("core_processed_timestamp")


@query(
    "core_flags",
    """
    SELECT is_valid_distance, is_valid_fare, is_valid_total_amount, is_outlier_trip,
      count(*) AS trip_count
    FROM (
      SELECT coalesce(d > 0 AND d <= 100, false) AS is_valid_distance,
        coalesce(f >= 0 AND f <= 1000, false) AS is_valid_fare,
        coalesce(t >= 0 AND t <= 1500, false) AS is_valid_total_amount,
        NOT (d > 0 AND d <= 100) OR NOT (f >= 0 AND f <= 1000) OR NOT (t >= 0 AND t <= 1500)
          AS is_outlier_trip
      FROM (SELECT trip_distance AS d,
              CASE WHEN "offset" % 9 = 0 THEN NULL ELSE fare_amount * 5 END AS f,
              CASE WHEN "offset" % 6 = 0 THEN NULL ELSE total_amount * 5 END AS t FROM trips))
    GROUP BY ALL
    """,
)
def _(spark, sf_dir):
    e = F.col("offset")
    rows = shapes.typed_trips(spark, sf_dir).withColumns(
        {
            "fare_amount": F.when(e % 9 != 0, F.col("fare_amount") * 5),
            "total_amount": F.when(e % 6 != 0, F.col("total_amount") * 5),
        }
    )
    flags = core_ops.validity_flags()
    return (
        rows.select(*[c.alias(n) for n, c in flags.items()])
        .groupBy(*flags)
        .agg(F.count("*").alias("trip_count"))
    )


@query("clean_impute", "SELECT * FROM clean")
def _(spark, sf_dir):
    return shapes.clean(spark, sf_dir).drop(
        "core_processed_timestamp", "clean_processed_timestamp"
    )
