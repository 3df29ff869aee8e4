"""Envelope to typed, deduplicated trips and one-row-per-hour weather."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import parse_local_ts, time_parts
from .joins import lookup_join, of_hours

ENVELOPE_TYPES = {
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "kafka_timestamp": "timestamp",
    "key": "string",
    "ingestion_timestamp": "timestamp",
    "ingestion_date": "string",
}


class Field(NamedTuple):
    source: str
    json_type: str
    name: str
    type: str
    kinds: tuple[str, ...] = ("yellow", "green")


# How the trip payload maps to Silver columns.  ``kinds`` lists the payloads
# that carry the field; elsewhere the column is a typed null.
TRIP_FIELDS = (
    Field("_source_file", "string", "source_file", "string"),
    Field("VendorID", "bigint", "vendor_id", "bigint"),
    Field("passenger_count", "double", "passenger_count", "double"),
    Field("trip_distance", "double", "trip_distance", "double"),
    Field("RatecodeID", "double", "ratecode_id", "int"),
    Field("store_and_fwd_flag", "string", "store_and_fwd_flag", "string"),
    Field("PULocationID", "bigint", "pu_location_id", "int"),
    Field("DOLocationID", "bigint", "do_location_id", "int"),
    Field("payment_type", "double", "payment_type", "int"),
    Field("fare_amount", "double", "fare_amount", "double"),
    Field("extra", "double", "extra", "double"),
    Field("mta_tax", "double", "mta_tax", "double"),
    Field("tip_amount", "double", "tip_amount", "double"),
    Field("tolls_amount", "double", "tolls_amount", "double"),
    Field("ehail_fee", "double", "ehail_fee", "double", ("green",)),
    Field("improvement_surcharge", "double", "improvement_surcharge", "double"),
    Field("total_amount", "double", "total_amount", "double"),
    Field("trip_type", "double", "trip_type", "int", ("green",)),
    Field("congestion_surcharge", "double", "congestion_surcharge", "double"),
    Field("airport_fee", "double", "airport_fee", "double", ("yellow",)),
)
# Local time fields in order of preference, per payload kind.
TIME_PREFIXES = {"yellow": ("tpep_", ""), "green": ("lpep_", ""), "auto": ("tpep_", "lpep_", "")}

WEATHER_FIELDS = (
    Field("timestamp", "string", "weather_timestamp_raw", "string"),
    Field("latitude", "double", "weather_latitude", "double"),
    Field("longitude", "double", "weather_longitude", "double"),
    Field("location", "string", "weather_location", "string"),
    Field("temperature_f", "double", "temperature_f", "double"),
    Field("humidity_percent", "double", "humidity_percent", "double"),
    Field("precipitation_mm", "double", "precipitation_mm", "double"),
    Field("weather_code", "int", "weather_code", "int"),
    Field("weather_description", "string", "weather_description", "string"),
    Field("wind_speed_kmh", "double", "wind_speed_kmh", "double"),
    Field("wind_direction_deg", "double", "wind_direction_deg", "double"),
    Field("cloud_cover_percent", "double", "cloud_cover_percent", "double"),
    Field("_source", "string", "weather_source", "string"),
)

# Weather columns carried onto a trip.
TRIP_WEATHER = [
    "weather_timestamp", "source_weather_timestamp", "weather_location", "temperature_f",
    "humidity_percent", "precipitation_mm", "weather_code", "weather_description",
    "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent",
]


def ensure_envelope(bronze: DataFrame) -> DataFrame:
    """Add envelope columns that an older dataset lacks, as typed nulls."""
    absent = {
        name: F.lit(None).cast(kind)
        for name, kind in ENVELOPE_TYPES.items()
        if name not in bronze.columns
    }
    return bronze.withColumns(absent) if absent else bronze


def _envelope_columns() -> list[Column]:
    return [
        F.col("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("kafka_timestamp"),
        F.col("ingestion_timestamp").alias("bronze_ingestion_timestamp"),
    ]


def _json_schema(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()])


def _parse_once(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Payload as struct column ``record``, parsed exactly once per event.

    Filters on derived columns would otherwise be pushed into the projection and
    each predicate would parse the JSON text again.  A generator over one element
    is a fence that predicates on its output do not cross, while predicates on
    envelope columns still pass below it to the scan.
    """
    record = F.from_json("json_data", schema)
    return events.select("*", F.explode(F.array(record)).alias("record")).drop("json_data")


def parse_trips(bronze: DataFrame, kind: str = "auto") -> DataFrame:
    """Typed trip columns from the JSON payload.

    ``kind`` is ``yellow`` or ``green`` for a single-type dataset, or ``auto``
    for mixed ones, where the payload, the envelope column and the path tag
    (``taxi_type_from_path``) are asked in turn for the taxi type.
    """
    prefixes = TIME_PREFIXES[kind]
    carried = [f for f in TRIP_FIELDS if kind == "auto" or kind in f.kinds]
    times = {
        end: [f"{prefix}{end}_datetime" for prefix in prefixes] for end in ("pickup", "dropoff")
    }
    json_fields = {f.source: f.json_type for f in carried}
    json_fields.update({name: "string" for names in times.values() for name in names})
    json_fields["_taxi_type"] = "string"

    events = ensure_envelope(bronze)
    record = F.col("record")
    if kind == "auto":
        tags = [F.col(c) for c in ("taxi_type", "taxi_type_from_path") if c in events.columns]
        taxi_type = F.coalesce(record["_taxi_type"], *tags)
    else:
        taxi_type = F.lit(kind)
    raw_times = [
        F.coalesce(*[record[name] for name in names]).alias(f"{end}_datetime_raw")
        for end, names in times.items()
    ]
    columns = [
        (record[f.source].try_cast(f.type) if f in carried else F.lit(None).cast(f.type)).alias(
            f.name
        )
        for f in TRIP_FIELDS
    ]
    parsed = _parse_once(events, _json_schema(json_fields))
    return parsed.select(
        *_envelope_columns(), taxi_type.alias("taxi_type"), *raw_times, *columns
    )


def parse_weather(bronze: DataFrame) -> DataFrame:
    schema = _json_schema({f.source: f.json_type for f in WEATHER_FIELDS})
    parsed = _parse_once(ensure_envelope(bronze), schema)
    return parsed.select(
        *_envelope_columns(),
        *[F.col("record")[f.source].alias(f.name) for f in WEATHER_FIELDS],
    )


def in_window(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Rows whose date lies in ``[start, end)``."""
    return df.filter(
        (F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date"))
    )


def window_hours(start: str, end: str) -> int:
    """Upper bound of distinct local hours in ``[start, end)`` (one spare for DST)."""
    return (date.fromisoformat(end) - date.fromisoformat(start)).days * 24 + 1


def ordered_times(df: DataFrame) -> DataFrame:
    """Keep trips that end no earlier than they start; an unknown end is fine."""
    return df.filter(
        F.col("dropoff_datetime").isNull()
        | (F.col("dropoff_datetime") >= F.col("pickup_datetime"))
    )


def _arrival_order(df: DataFrame) -> list[Column]:
    """Total order of copies: arrival first, then content, so that reruns agree."""
    arrival = [c for c in ("kafka_timestamp", "partition", "offset") if c in df.columns]
    rest = [c for c in df.columns if c not in arrival and c != "silver_processed_timestamp"]
    return [F.col(c).asc() for c in arrival] + [F.xxhash64(*rest).asc()]


def keep_first(
    df: DataFrame, keys: list[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """First row per key, by arrival unless ``order`` says otherwise; null keys are equal.

    ``row_number() = 1`` is planned with a per-partition group limit below the
    exchange, so each map task sends at most one row per key.  A key repeated in
    a third of all rows therefore shuffles no more than one row per input task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*(order or _arrival_order(df)))
    return (
        df.withColumn("_copy", F.row_number().over(ranked)).filter("_copy = 1").drop("_copy")
    )


def dedup_transport(df: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset).

    A row without an offset was not delivered by the event log; null keys would
    make all such rows copies of each other, so they pass through untouched.
    """
    # A number of its own keeps every unaddressed row apart, in the same pass over the input.
    apart = F.when(F.col("offset").isNull(), F.monotonically_increasing_id())
    # Copies of one record differ in their arrival at most.
    arrival = [F.col(c) for c in ("kafka_timestamp",) if c in df.columns] or [F.lit(0)]
    numbered = df.withColumn("_apart", apart)
    return keep_first(numbered, [*K.TRANSPORT_KEY, "_apart"], arrival).drop("_apart")


def dedup_business(df: DataFrame) -> DataFrame:
    """One row per physical trip, however often it was sent."""
    return keep_first(df, K.BUSINESS_KEY)


def type_trips(parsed: DataFrame) -> DataFrame:
    """Parse times and derive time parts; keep the source strings."""
    pickup = F.col("pickup_datetime")
    return (
        parsed.withColumnsRenamed(
            {
                "pickup_datetime_raw": "source_pickup_datetime",
                "dropoff_datetime_raw": "source_dropoff_datetime",
            }
        )
        .withColumns(
            {
                f"{end}_datetime": parse_local_ts(F.col(f"source_{end}_datetime"))
                for end in ("pickup", "dropoff")
            }
        )
        .withColumns(time_parts("pickup", pickup))
        .withColumn("silver_processed_timestamp", F.current_timestamp())
    )


def normalize_trips(
    *parsed: DataFrame, start: str = K.WINDOW_START, end: str = K.WINDOW_END, dedup: bool = True
) -> DataFrame:
    """Union of parsed sources to clean trip rows.

    All row filters run before the two deduplication shuffles.
    """
    union = parsed[0]
    for other in parsed[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    # The hour is known whenever the pickup time is.
    trips = type_trips(union).dropna(subset=["pickup_datetime", "taxi_type", "pu_location_id"])
    trips = ordered_times(in_window(trips, "pickup_date", start, end))
    return dedup_business(dedup_transport(trips)) if dedup else trips


def normalize_weather(
    parsed: DataFrame, start: str = K.WINDOW_START, end: str = K.WINDOW_END, dedup: bool = True
) -> DataFrame:
    """Weather readings with local hour, inside the date window, one per offset."""
    stamp = F.col("weather_timestamp")
    typed = (
        parsed.withColumnRenamed("weather_timestamp_raw", "source_weather_timestamp")
        .withColumn("weather_timestamp", parse_local_ts(F.col("source_weather_timestamp")))
        .withColumns(time_parts("weather", stamp))
        .withColumn("silver_processed_timestamp", F.current_timestamp())
        .dropna(subset=["weather_hour"])
    )
    readings = in_window(typed, "weather_date", start, end)
    return dedup_transport(readings) if dedup else readings


def hourly_weather(readings: DataFrame, mode: str = "first_non_null") -> DataFrame:
    """Exactly one row per local hour, so a join on the hour cannot multiply trips.

    ``first_non_null`` takes, column by column, the earliest reading that has a
    value; ``first_row`` keeps the earliest reading as it is.  Both reduce map
    side first: an hour with very many readings costs one row per task.
    """
    if mode == "first_row":
        return keep_first(readings, ["weather_hour"])
    if mode != "first_non_null":
        raise ValueError(f"unknown mode {mode!r}")
    names = [
        "weather_timestamp", "source_weather_timestamp", "weather_date", "weather_year_month",
        "weather_latitude", "weather_longitude", "weather_location", "temperature_f",
        "humidity_percent", "precipitation_mm", "weather_code", "weather_description",
        "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent", "weather_source",
    ]
    arrival = F.struct("kafka_timestamp", "partition", "offset", "source_weather_timestamp")
    # A null ordering is skipped by min_by, which leaves out null values.
    firsts = [
        F.min_by(F.col(n), F.when(F.col(n).isNotNull(), arrival)).alias(n) for n in names
    ]
    return readings.groupBy("weather_hour").agg(
        *firsts, F.max("silver_processed_timestamp").alias("silver_processed_timestamp")
    )


def join_weather(
    trips: DataFrame, weather: DataFrame, *, window: tuple[str, str] | None = None
) -> DataFrame:
    """Trips with the weather of their pickup hour; trips without weather stay.

    ``window`` (first and last day) limits the weather table to the hours that
    trips of that window can have, one row each, which lets it be broadcast.
    """
    features = weather.select(F.col("weather_hour").alias("pickup_hour"), *TRIP_WEATHER)
    if window is not None:
        features = of_hours(features, "pickup_hour", *window)
    return lookup_join(trips, features, "pickup_hour")
