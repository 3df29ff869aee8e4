"""Counts that streams keep up to date in a table: late rows change hours long past.

A micro-batch is pre-aggregated and replaces the folder that its batch id names, so a
replayed batch changes nothing and there is no state to expire.  Reading adds up the
folders; now and then they are folded into one base table, whose number is made visible
by one append to a log after it is complete.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import try_read

# Batches that reading adds up at most, before they are folded.
FOLD_EVERY = 50


class MergedCounts(NamedTuple):
    """A table of sums by ``keys`` under ``root``; ``schema`` names keys and sums in DDL.

    One stream writes to a table; its batches come one after another.
    """

    spark: SparkSession
    root: str
    schema: str
    keys: Sequence[str]

    @property
    def _struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def _add_up(self, rows: DataFrame) -> DataFrame:
        sums = [
            F.sum(f.name).cast(f.dataType).alias(f.name)
            for f in self._struct
            if f.name not in self.keys
        ]
        return rows.groupBy(*self.keys).agg(*sums).select(*self._struct.names)

    @property
    def _batches(self) -> DataFrame:
        whole = T.StructType([*self._struct.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(whole).parquet(f"{self.root}/batches")

    def _base(self, upto: int) -> DataFrame:
        return self.spark.read.schema(self._struct).parquet(f"{self.root}/base/{upto}")

    def folded(self) -> int:
        """The last batch that the base table holds; -1 without one."""
        log = try_read(self.spark, f"{self.root}/folds")
        return -1 if log is None else log.agg(F.max("upto")).first()[0]

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Put the sums of one batch in the place of what an earlier try has left of it."""
        self._add_up(rows).write.mode("overwrite").parquet(f"{self.root}/batches/batch={batch_id}")

    def read(self) -> DataFrame:
        """Sums by key over all merged batches."""
        upto = self.folded()
        rows = self._base(upto) if upto >= 0 else self.spark.createDataFrame([], self._struct)
        if try_read(self.spark, f"{self.root}/batches") is not None:
            # A filter on folders: those of folded batches are not read.
            rows = rows.unionByName(self._batches.filter(F.col("batch") > upto).drop("batch"))
        return self._add_up(rows)

    def fold(self, upto: int) -> None:
        """Make one base table of all batches up to ``upto``, which must be committed."""
        before = self.folded()
        if upto <= before:
            return
        rows = self._batches.filter(F.col("batch").between(before + 1, upto)).drop("batch")
        if before >= 0:
            rows = rows.unionByName(self._base(before))
        self._add_up(rows).write.mode("overwrite").parquet(f"{self.root}/base/{upto}")
        log = self.spark.createDataFrame([(upto,)], "upto long")
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/folds")


def demand_table(spark: SparkSession, root: str) -> MergedCounts:
    """Demand by pickup zone and hour."""
    return MergedCounts(
        spark,
        root,
        "pu_location_id int, pickup_hour timestamp, demand long",
        ("pu_location_id", "pickup_hour"),
    )


def merge_demand(
    trips: DataFrame,
    table: MergedCounts,
    checkpoint: str,
    *,
    time_column: str = "pickup_datetime",
    fold_every: int = FOLD_EVERY,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep ``table`` at the demand of all trips that have arrived, open hours included.

    A batch's trips are counted per zone and hour before anything is shuffled.  A batch is
    committed before the next one starts, so that a batch may fold all those before it.
    """
    counted = trips.select(
        "pu_location_id",
        F.date_trunc("hour", time_column).alias("pickup_hour"),
        F.lit(1).cast("long").alias("demand"),
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id)
        if batch_id and batch_id % fold_every == 0:
            table.fold(batch_id - 1)

    writer = counted.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
