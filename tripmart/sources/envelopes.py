"""Turn source files and weather responses into event envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import weather_description
from ..operators.joins import join_zones

# Microsecond ISO timestamps and explicit nulls; the JSON writer's own defaults
# cut to milliseconds and leave null fields out.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def source_file_name() -> Column:
    """The trip file that a row was read from, by the file source's own metadata.

    A dataset written by Spark is a folder of part files; the folder has the name then.
    """
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    named = F.regexp_extract(path, "([^/]*tripdata[^/]*)", 1)
    return F.when(named != "", named).otherwise(F.element_at(F.split(path, "/"), -1))


def trips_to_envelope(
    trips: DataFrame,
    *,
    source_file: Column | None = None,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Trip file rows (batch or stream) to (topic, key, value) events.

    The file name decides taxi type and topic, as in ``yellow_tripdata_2024-01``.
    Every source column is kept under its own name; with ``zones`` the pickup
    and drop-off zone attributes are added.  On a stream the checkpoint of the
    query remembers which files were sent.
    """
    file_name = source_file_name() if source_file is None else source_file
    lowered = F.lower(F.col("_source_file"))
    kind = F.when(lowered.contains("yellow"), "yellow").when(lowered.contains("green"), "green")
    topic = F.when(F.col("_taxi_type") == "yellow", K.YELLOW_TOPIC).when(
        F.col("_taxi_type") == "green", K.GREEN_TOPIC
    )
    payload = trips.columns
    events = trips.withColumn("_source_file", file_name).withColumn("_taxi_type", kind)
    # A file whose name tells no type has no topic to go to.
    events = events.withColumn(
        "_taxi_type",
        F.coalesce(
            F.col("_taxi_type"),
            F.raise_error(
                F.concat(F.lit("no taxi type in file name "), F.col("_source_file"))
            ).cast("string"),
        ),
    )
    if zones is not None:
        for end in ("pickup", "dropoff"):
            named = [f"{prefix}_{end}_datetime" for prefix in ("tpep", "lpep")]
            stamps = [F.col(name) for name in named if name in payload]
            if stamps and f"{end}_datetime" not in payload:
                events = events.withColumn(f"{end}_datetime", F.coalesce(*stamps))
        events = join_zones(
            events, zones, pickup_key="PULocationID", dropoff_key="DOLocationID"
        )
    events = events.withColumn("_ingestion_timestamp", F.current_timestamp().cast("string"))
    return events.select(
        topic.alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"),
    )


_HOURLY = T.StructType(
    [
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("relative_humidity_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("weather_code", T.ArrayType(T.IntegerType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("wind_direction_10m", T.ArrayType(T.DoubleType())),
        T.StructField("cloud_cover", T.ArrayType(T.DoubleType())),
    ]
)
WEATHER_RESPONSE_SCHEMA = T.StructType([T.StructField("hourly", _HOURLY)])


def explode_weather(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per hour from responses that hold parallel hourly arrays."""
    hourly = F.from_json(F.col(body), WEATHER_RESPONSE_SCHEMA)["hourly"]
    # Arrays that are absent or shorter than the time array give nulls.
    values = [
        F.get(F.col("hourly")[f.name], F.col("i")).alias(f.name)
        for f in _HOURLY.fields
        if f.name != "time"
    ]
    rows = (
        responses.select(hourly.alias("hourly"))
        .select("hourly", F.posexplode("hourly.time").alias("i", "time"))
        .select("time", *values)
    )
    return rows.filter(F.col("time").isNotNull()).select(
        F.col("time").alias("timestamp"),
        F.lit(K.WEATHER_LATITUDE).alias("latitude"),
        F.lit(K.WEATHER_LONGITUDE).alias("longitude"),
        F.lit(K.WEATHER_LOCATION).alias("location"),
        F.col("temperature_2m").alias("temperature_f"),
        F.col("relative_humidity_2m").alias("humidity_percent"),
        F.col("precipitation").alias("precipitation_mm"),
        F.col("weather_code"),
        weather_description(F.col("weather_code")).alias("weather_description"),
        F.col("wind_speed_10m").alias("wind_speed_kmh"),
        F.col("wind_direction_10m").alias("wind_direction_deg"),
        F.col("cloud_cover").alias("cloud_cover_percent"),
        F.lit(K.WEATHER_SOURCE).alias("_source"),
    )


def weather_to_envelope(responses: DataFrame, body: str = "body") -> DataFrame:
    events = explode_weather(responses, body).withColumn(
        "_ingestion_timestamp", F.current_timestamp().cast("string")
    )
    return events.select(
        F.lit(K.WEATHER_TOPIC).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"),
    )
