"""Streams over the benchmark tables, drained to a folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import publish, silver
from ..session import materialize, scratch_path
from ..sources.envelopes import trips_to_envelope
from ..streaming import bronze, live, merged
from . import shapes
from .registry import query


def _event_stream(spark, sf_dir):
    static = shapes.table(spark, sf_dir, "events")
    # A pattern, because a stream source takes folders and patterns, not one file.
    return spark.readStream.schema(static.schema).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")


def _drained(spark, stream, label):
    base = scratch_path(spark, label)
    live.drain(stream, f"{base}/data", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def _log(events):
    """Events as log records: JSON value with topic, partition and offset."""
    e = F.col("event_id")
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "value")).cast("binary").alias("value"),
        F.lit("nyc_taxi_yellow").alias("topic"),
        (e % 4).cast("int").alias("partition"),
        e.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


@query(
    "stream_bronze",
    """
    SELECT 'nyc_taxi_yellow' AS topic, (event_id % 4)::INT AS "partition", event_id AS "offset",
      ts AS kafka_timestamp, 0 AS kafka_timestamp_type, NULL::VARCHAR AS "key", user_id,
      'yellow' AS taxi_type
    FROM events
    """,
)
def _(spark, sf_dir):
    base = scratch_path(spark, "stream-bronze")
    tag, value = bronze.topic_tag("nyc_taxi_yellow")
    feed = bronze.Feed(
        _log(_event_stream(spark, sf_dir)), tag, value, f"{base}/data", f"{base}/checkpoint"
    )
    bronze.run_ingestion(spark, [feed])
    stored = spark.read.parquet(feed.path)
    return stored.select(
        "topic", "partition", "offset", "kafka_timestamp", "kafka_timestamp_type", "key",
        F.get_json_object("json_data", "$.user_id").cast("bigint").alias("user_id"),
        "taxi_type",
    )


@query(
    "stream_trip_envelopes",
    """
    SELECT 'nyc_taxi_green' AS topic, event_id AS "VendorID", user_id AS "PULocationID",
      'green' AS taxi_type, ts AS pickup FROM events
    """,
)
def _(spark, sf_dir):
    """Trip rows to envelopes on a stream; the query checkpoint remembers sent files."""
    trips = _event_stream(spark, sf_dir).select(
        F.col("event_id").alias("VendorID"),
        F.col("ts").alias("lpep_pickup_datetime"),
        F.col("user_id").alias("PULocationID"),
    )
    sent = _drained(
        spark,
        trips_to_envelope(trips, source_file=F.lit("green_tripdata_2024-01.parquet")),
        "stream-envelopes",
    )
    fields = F.from_json(
        "value", "VendorID bigint, PULocationID bigint, _taxi_type string, "
        "lpep_pickup_datetime string"
    )
    return sent.select("topic", fields.alias("r")).select(
        "topic",
        "r.VendorID",
        "r.PULocationID",
        F.col("r._taxi_type").alias("taxi_type"),
        F.try_to_timestamp("r.lpep_pickup_datetime").alias("pickup"),
    )


@query(
    "stream_demand",
    f"""
    SELECT (user_id % {shapes.ZONES} + 1)::INT AS pu_location_id,
      date_trunc('hour', ts)::TIMESTAMP AS pickup_hour, count(*)::INT AS demand
    FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
      <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)
    GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    """Hours that the watermark has closed when the input ends."""
    trips = _event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("pickup_datetime"),
        (F.col("user_id") % shapes.ZONES + 1).cast("int").alias("pu_location_id"),
    )
    return _drained(spark, live.stream_demand(trips), "stream-demand")


@query(
    "stream_demand_merged",
    f"""
    SELECT (user_id % {shapes.ZONES} + 1)::INT AS pu_location_id,
      date_trunc('hour', ts)::TIMESTAMP AS pickup_hour, count(*) AS demand
    FROM events GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    """All hours of all events, which arrive in several files and out of order."""
    base = scratch_path(spark, "stream-merged")
    rows = shapes.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("pickup_datetime"),
        (F.col("user_id") % shapes.ZONES + 1).cast("int").alias("pu_location_id"),
    )
    rows.repartition(8, F.date_trunc("day", "pickup_datetime")).write.parquet(f"{base}/arrived")
    trips = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    table = merged.demand_table(spark, f"{base}/demand")
    # The second run finds nothing new and changes nothing.
    for _run in range(2):
        merged.merge_demand(
            trips.parquet(f"{base}/arrived"), table, f"{base}/checkpoint", fold_every=3
        ).awaitTermination()
    return table.read()


@query(
    "stream_three_feeds",
    """
    SELECT feed, topic, "partition", "offset", count(*) OVER (PARTITION BY feed) AS feed_rows
    FROM (
      SELECT taxi_type AS feed, 'nyc_taxi_' || taxi_type AS topic, (e % 4)::INT AS "partition",
        CASE WHEN copy = 2 THEN -(e + 1) ELSE e END AS "offset" FROM copies
      UNION ALL SELECT 'weather', 'weather_stream', (event_id % 2)::INT, event_id FROM events)
    """,
)
def _(spark, sf_dir):
    """Yellow, green and weather folders drained side by side; rows as the listener counts them."""
    base = scratch_path(spark, "stream-feeds")
    trips = shapes.bronze_trips(spark, sf_dir)
    logs = {
        "yellow": trips.filter("taxi_type = 'yellow'"),
        "green": trips.filter("taxi_type = 'green'"),
        "weather": shapes.bronze_weather(spark, sf_dir),
    }
    feeds = []
    for name, log in logs.items():
        log.select(
            F.lit(None).cast("binary").alias("key"),
            F.col("json_data").cast("binary").alias("value"),
            "topic",
            "partition",
            "offset",
            F.col("kafka_timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        ).write.parquet(f"{base}/log/{name}")
        events = bronze.read_envelope_stream(spark, f"{base}/log/{name}")
        topic = "weather_stream" if name == "weather" else f"nyc_taxi_{name}"
        feeds.append(
            bronze.Feed(
                events, *bronze.topic_tag(topic), f"{base}/bronze/{name}", f"{base}/checkpoint/{name}"
            )
        )
    result = None
    for done in bronze.run_ingestion(spark, feeds):
        part = spark.read.parquet(done.feed.path).select(
            F.col(done.feed.tag).alias("feed"), "topic", "partition", "offset",
            F.lit(done.rows).cast("long").alias("feed_rows"),
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "stream_dedup",
    """
    SELECT DISTINCT 'nyc_taxi_yellow' AS topic, (event_id % 4)::INT AS "partition",
      event_id AS "offset" FROM events
    """,
)
def _(spark, sf_dir):
    """Every event delivered once or twice comes out once."""
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("offset") % 3 == 0, 2).otherwise(1)))
    log = _log(_event_stream(spark, sf_dir)).withColumn("copy", copies)
    unique = live.dedup_stream(log, "timestamp")
    return _drained(
        spark, unique.select("topic", "partition", "offset"), "stream-dedup"
    )


@query(
    "stream_weather_join",
    """
    SELECT t."offset", t.pickup_hour, w.temperature_f, w.precipitation_mm
    FROM trips t LEFT JOIN weather w ON t.pickup_hour = w.weather_hour
    """,
)
def _(spark, sf_dir):
    trips = _event_stream(spark, sf_dir).select(
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("pickup_datetime")
    )
    weather = shapes.typed_weather(spark, sf_dir).select(
        "weather_hour", "temperature_f", "precipitation_mm"
    )
    joined = live.stream_weather_join(trips, weather, window=shapes.DAYS)
    return _drained(
        spark,
        joined.select("offset", "pickup_hour", "temperature_f", "precipitation_mm"),
        "stream-weather",
    )


@query(
    "stream_silver",
    """
    SELECT taxi_type, "offset", pickup_datetime, pu_location_id, fare_amount FROM parsed
    """,
)
def _(spark, sf_dir):
    """Bronze written by a stream, then parsed as a batch."""
    stored = materialize(shapes.bronze_trips(spark, sf_dir), "stream-source")
    events = spark.readStream.schema(stored.schema).parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
    landed = _drained(spark, events, "stream-silver")
    typed = silver.type_trips(silver.parse_trips(landed))
    return typed.dropna(subset=["pickup_datetime"]).select(
        "taxi_type", "offset", "pickup_datetime", "pu_location_id", "fare_amount"
    )


@query(
    "publish_cycle",
    """
    SELECT target_table, source_row_count, target_row_count, status FROM (
      SELECT 'zone_summary' AS target_table, count(*) AS source_row_count,
        count(*) AS target_row_count FROM zone_mart
      UNION ALL SELECT 'hourly_kpi', count(*), count(*) FROM hourly_mart),
    (VALUES ('failed'), ('passed')) s(status)
    """,
)
def _(spark, sf_dir):
    """Two publication attempts of two marts; the second supersedes the first."""
    warehouse = publish.Warehouse(spark, scratch_path(spark, "warehouse"))
    stored = {
        "hourly_kpi": materialize(shapes.hourly_mart(spark, sf_dir), "hourly"),
        "zone_summary": materialize(shapes.zone_mart(spark, sf_dir), "zones"),
    }
    names = {name: f"marts/{name}" for name in stored}
    for _attempt in range(2):
        staged = {name: warehouse.stage(name, df, "mart") for name, df in stored.items()}
        warehouse.promote(staged, names)
    for name, df in stored.items():
        warehouse.validate(name, df, "mart")
    return warehouse.runs().select(
        "target_table", "source_row_count", "target_row_count", "status"
    )
