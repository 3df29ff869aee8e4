"""Fact-to-dimension joins.

A dimension is broadcast only when its size is proven: either it is cut to a
bounded key range with one row per key right before the join (``of_hours``), its
keys are limited by construction, or the optimizer measures it
(``spark.sql.autoBroadcastJoinThreshold`` on file sizes, and AQE on real shuffle
sizes).  Beyond that the join is an ordinary shuffle join, and AQE splits
partitions that a hot key makes too large.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a dimension that may be broadcast by hint.  At a few hundred bytes
# per row this stays within tens of megabytes.
BROADCAST_ROW_BOUND = 100_000


def sized(dim: DataFrame, proven_rows: int | None) -> DataFrame:
    """``dim`` with a broadcast hint if its proven row bound is small enough."""
    if proven_rows is not None and proven_rows <= BROADCAST_ROW_BOUND:
        return F.broadcast(dim)
    return dim


def of_hours(dim: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """``dim`` cut to hours of the days from ``start`` to ``end``, one row per hour.

    That bounds its rows by the hours of the window, so it carries the broadcast
    hint as long as these are few enough.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    hour = F.col(column)
    inside = dim.filter(
        F.to_date(hour).between(first, last) & (F.date_trunc("hour", hour) == hour)
    ).dropDuplicates([column])
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return sized(inside, 24 * days)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    *,
    how: str = "left",
    proven_rows: int | None = None,
) -> DataFrame:
    return fact.join(sized(dim, proven_rows), on, how)


def zone_role(zones: DataFrame, role: str, key: str) -> DataFrame:
    """Zone attributes under role-prefixed names, keyed for one end of a trip."""
    return zones.select(
        F.col("location_id").alias(key),
        F.col("borough").alias(f"{role}_zone_borough"),
        F.col("zone").alias(f"{role}_zone_name"),
        F.col("latitude").alias(f"{role}_zone_lat"),
        F.col("longitude").alias(f"{role}_zone_lon"),
    )


def join_zones(
    trips: DataFrame,
    zones: DataFrame,
    *,
    pickup_key: str = "pu_location_id",
    dropoff_key: str = "do_location_id",
    proven_rows: int | None = None,
) -> DataFrame:
    """Add pickup and drop-off zone attributes; trips without a zone stay."""
    ends = {"pickup": pickup_key, "dropoff": dropoff_key}
    for role, key in ends.items():
        trips = lookup_join(trips, zone_role(zones, role, key), key, proven_rows=proven_rows)
    return trips
