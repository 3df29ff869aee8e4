"""Positions in a global time order, found without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import values_at_ranks


def _day(column: str):
    return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date"))


def time_at_fraction(df: DataFrame, column: str, fractions: dict[str, float]) -> dict:
    """Time stamps at given fractions of the time-ordered rows.

    Rows are counted per time stamp and the counts run up per day, so the work
    per task is bounded by the number of days and of stamps within a day.  One
    row with one value per fraction comes back to the driver.
    """
    positions = {
        name: F.floor(F.col("group_rows") * F.lit(float(f))) for name, f in fractions.items()
    }
    return values_at_ranks(df, column, positions, bucket=_day(column)).first().asDict()


def time_at_row(df: DataFrame, column: str, rows: dict[str, int]) -> dict:
    """Time stamps at given 0-based row positions of the time order."""
    positions = {name: F.lit(int(r)) for name, r in rows.items()}
    return values_at_ranks(df, column, positions, bucket=_day(column)).first().asDict()


def with_row_index(
    df: DataFrame, column: str, tie_breakers: Sequence[str], name: str = "row_index"
) -> DataFrame:
    """0-based position of every row in the order of ``column`` and the tie breakers.

    Offsets come from counts per stamp; only rows that share a stamp are sorted
    together (at most one per zone in a demand table).
    """
    day = _day(column)
    stamps = df.groupBy(day.alias("_day"), F.col(column).alias("_at")).agg(
        F.count("*").alias("_n")
    )
    days = stamps.groupBy("_day").agg(F.sum("_n").alias("_rows"))
    running = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    # One row per calendar day, so this ordering window stays small.
    days = days.select("_day", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_day").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stamps.withColumn("_earlier", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(days, "_day")
        .select("_at", (F.col("_before") + F.col("_earlier")).alias("_offset"))
    )
    within = Window.partitionBy(column).orderBy(*tie_breakers)
    return (
        df.withColumn("_rank", F.row_number().over(within))
        .join(offsets, F.col(column) == F.col("_at"))
        .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
        .drop("_rank", "_at", "_offset")
    )
