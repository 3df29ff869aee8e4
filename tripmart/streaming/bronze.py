"""Event log to Bronze: stateless projection, append-only parquet."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import constants as K

# What a log source delivers, and what a file source must look like to stand in.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def read_kafka_stream(
    spark: SparkSession,
    topic: str,
    servers: str,
    *,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = 1_000_000,
) -> DataFrame:
    """Kafka topic as a stream (needs the Kafka connector package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_envelope_stream(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files with the log schema as a stream."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def to_bronze(events: DataFrame, tag: str, value: str) -> DataFrame:
    """Envelope columns, payload as text, a constant type tag and ingestion time.

    ``tag`` is ``taxi_type`` for trips and ``data_type`` for weather.
    """
    now = F.current_timestamp()
    return events.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("timestampType").alias("kafka_timestamp_type"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("json_data"),
        F.lit(value).alias(tag),
        now.alias("ingestion_timestamp"),
        F.date_format(now, "yyyy-MM-dd").alias("ingestion_date"),
    )


def write_bronze_stream(
    bronze: DataFrame, path: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Start the append sink; ``available_now`` drains what is there and stops."""
    writer = (
        bronze.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingestion_date")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


class Feed(NamedTuple):
    """One stream to ingest."""

    events: DataFrame
    tag: str
    value: str
    path: str
    checkpoint: str


def topic_tag(topic: str) -> tuple[str, str]:
    """Type tag column and value for a topic."""
    if topic == K.WEATHER_TOPIC:
        return "data_type", "weather"
    return "taxi_type", "yellow" if "yellow" in topic else "green"


class FeedProgress(StreamingQueryListener):
    """What the queries of a run have done: batches, rows and errors by run id."""

    def __init__(self) -> None:
        self._news = threading.Condition()
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = str(progress.runId)
        with self._news:
            self.rows[key] = self.rows.get(key, 0) + progress.numInputRows
            self.batches[key] = self.batches.get(key, 0) + (progress.numInputRows > 0)
            self._news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self.ended[str(event.runId)] = event.exception
            self._news.notify_all()

    def wait(
        self, queries: Sequence[StreamingQuery], *, for_all: bool, grace: float = 30.0
    ) -> None:
        """Return when one query has failed, or all (else any) of them have ended.

        Events come a little after the fact; should they not come at all, the queries'
        own state decides after ``grace`` seconds.
        """
        wanted = [str(q.runId) for q in queries]

        def settled() -> bool:
            found = [k for k in wanted if k in self.ended]
            failed = any(self.ended[k] for k in found)
            return failed or len(found) == len(wanted) or (not for_all and bool(found))

        with self._news:
            while not self._news.wait_for(settled, grace):
                active = [q.isActive for q in queries]
                if not any(active) or (not all(active) and not for_all):
                    return


class Ingested(NamedTuple):
    """A feed after its run."""

    feed: Feed
    query: StreamingQuery
    batches: int
    rows: int


def run_ingestion(
    spark: SparkSession, feeds: Sequence[Feed], *, available_now: bool = True
) -> list[Ingested]:
    """Run several feeds side by side and say what each has ingested.

    Draining waits for all of them; continuous mode waits until any one ends.  A
    listener tells of the first that fails, whichever it is: the feeds still running
    are stopped at once and its error is raised.
    """
    progress = FeedProgress()
    spark.streams.addListener(progress)
    running: list[StreamingQuery] = []
    try:
        for feed in feeds:
            bronze = to_bronze(feed.events, feed.tag, feed.value)
            running.append(
                write_bronze_stream(
                    bronze, feed.path, feed.checkpoint, available_now=available_now
                )
            )
        progress.wait(running, for_all=available_now)
        for query in running:
            if query.exception() is not None:
                raise query.exception()
    except BaseException:
        for query in running:
            query.stop()
        raise
    finally:
        spark.streams.removeListener(progress)
    return [
        Ingested(feed, q, progress.batches.get(str(q.runId), 0), progress.rows.get(str(q.runId), 0))
        for feed, q in zip(feeds, running, strict=True)
    ]
