"""Optional streaming twins of batch steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import constants as K
from ..operators.joins import of_hours


def dedup_stream(events: DataFrame, time_column: str, delay: str = "1 hour") -> DataFrame:
    """Drop copies of a log record that arrive within the watermark delay.

    State is keyed by the full transport key and expires with the watermark.
    """
    return events.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(
        K.TRANSPORT_KEY
    )


def stream_demand(
    trips: DataFrame, *, time_column: str = "pickup_datetime", delay: str = "1 hour"
) -> DataFrame:
    """Demand per zone and hour; an hour is emitted once the watermark passes its end.

    Partial counts are merged per task before the state shuffle.
    """
    return (
        trips.withWatermark(time_column, delay)
        .groupBy(F.window(time_column, "1 hour"), "pu_location_id")
        .agg(F.count("*").cast("int").alias("demand"))
        .select("pu_location_id", F.col("window.start").alias("pickup_hour"), "demand")
    )


def stream_weather_join(
    trips: DataFrame, weather: DataFrame, *, window: tuple[str, str] | None = None
) -> DataFrame:
    """Streaming trips with the weather of their hour from a stored table.

    ``window`` as in ``silver.join_weather``.
    """
    keyed = weather.withColumnRenamed("weather_hour", "pickup_hour")
    if window is not None:
        keyed = of_hours(keyed, "pickup_hour", *window)
    return trips.withColumn("pickup_hour", F.date_trunc("hour", "pickup_datetime")).join(
        keyed, "pickup_hour", "left"
    )


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available into a parquet folder and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
