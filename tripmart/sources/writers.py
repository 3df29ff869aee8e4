"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite"
) -> None:
    """Overwrite a dataset laid out by partition keys.

    The ``rebalance`` hint clusters rows by the keys so that each directory gets
    few files, and lets AQE split a partition that is too large (a hot month)
    over several tasks by the advisory size instead of leaving it to one writer.
    """
    if not keys:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def rewrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, and leave all others as they are.

    For a backfill: the corrected rows of a month take the place of that month.  The new
    files become visible when the job commits; without rows nothing changes.
    """
    df.hint("rebalance", *keys).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*keys).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """Quality report as one JSON-lines file; a report has a few rows per column."""
    report.withColumn("checked_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "overwrite",
    writers: int = 4,
    batch_size: int = 5000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write to a database through at most ``writers`` connections.

    ``numPartitions`` caps the connections: Spark would coalesce the whole stage
    before the write to that many tasks.  The repartition keeps the work upstream
    on as many tasks as it has.
    """
    out = (
        df.repartition(writers).write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", writers)
        .option("batchsize", batch_size)
        .mode(mode)
    )
    for key, value in (properties or {}).items():
        out = out.option(key, value)
    out.save()
