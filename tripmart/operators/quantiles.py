"""Exact order statistics without sorting a whole group in one task.

Values are first counted per (group, bucket, value) with map-side partials.
Bucket totals are small; running them up tells how many rows precede each
bucket, and a window inside one bucket finishes the rank.  Neither a hot group
nor a hot value is ever gathered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cumulative_counts(
    df: DataFrame, keys: Sequence[str], value: str, bucket: Column, weight: str | None = None
) -> DataFrame:
    """Distinct values per group with their count ``n`` and ranks.

    Adds ``first_rank`` and ``last_rank`` (1-based positions of the value among
    the group's sorted rows) and ``group_rows``.  ``bucket`` must not decrease
    as ``value`` grows.  Null values are left out.  With ``weight``, a row stands for
    that many.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, bucket.alias("_bucket"), F.col(value).alias("_value"))
        .agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    )
    totals = counted.groupBy(*keys, "_bucket").agg(F.sum("n").alias("_rows"))
    in_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = in_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        F.col("_bucket").alias("_g_bucket"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(in_group).alias("group_rows"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    ranked = counted.withColumn("_upto", F.sum("n").over(inside))
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    joined = ranked.join(offsets, [F.col("_bucket") == F.col("_g_bucket"), *same])
    return joined.select(
        *keys,
        F.col("_value").alias(value),
        "n",
        (F.col("_before") + F.col("_upto") - F.col("n") + 1).alias("first_rank"),
        (F.col("_before") + F.col("_upto")).alias("last_rank"),
        "group_rows",
    )


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, *, bucket: Column
) -> DataFrame:
    """Smallest value with at least ``fraction`` of its group at or below it."""
    target = F.greatest(F.ceil(F.col("group_rows") * F.lit(float(fraction))), F.lit(1))
    ranked = cumulative_counts(df, keys, value, bucket)
    hit = ranked.filter((F.col("first_rank") <= target) & (target <= F.col("last_rank")))
    return hit.select(*keys, F.col(value).alias("quantile"))


def values_at_ranks(
    df: DataFrame, value: str, fractions: dict[str, Column], *, bucket: Column
) -> DataFrame:
    """Values at several 0-based row positions of the whole frame, one row.

    ``fractions`` maps a name to an expression over ``group_rows``.
    """
    ranked = cumulative_counts(df, [], value, bucket)
    position = {name: expr.cast("bigint") + 1 for name, expr in fractions.items()}
    picks = [
        F.max(
            F.when(
                (F.col("first_rank") <= p) & (p <= F.col("last_rank")),
                F.col(value),
            )
        ).alias(name)
        for name, p in position.items()
    ]
    return ranked.agg(*picks)
