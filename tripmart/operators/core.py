"""Compact fact table (Core) and its imputed twin (Clean)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

_FLAGS = ("is_valid_distance", "is_valid_fare", "is_valid_total_amount", "is_outlier_trip")


def _ranges() -> dict[str, Column]:
    """Range conditions; null where the measured value is null."""
    distance, fare, total = F.col("trip_distance"), F.col("fare_amount"), F.col("total_amount")
    return {
        "is_valid_distance": (distance > 0) & (distance <= K.MAX_VALID_DISTANCE),
        "is_valid_fare": (fare >= 0) & (fare <= K.MAX_VALID_FARE),
        "is_valid_total_amount": (total >= 0) & (total <= K.MAX_VALID_TOTAL),
    }


def validity_flags() -> dict[str, Column]:
    """Three two-valued validity flags and one three-valued outlier flag.

    A missing value is not valid.  The outlier flag is true when any range
    fails, null when none fails but some value is missing, false otherwise.
    """
    ranges = _ranges()
    flags = {name: F.coalesce(cond, F.lit(False)) for name, cond in ranges.items()}
    distance, fare, total = ranges.values()
    flags["is_outlier_trip"] = ~(distance & fare & total)
    return flags


def build_core(trips: DataFrame) -> DataFrame:
    """Narrow types, decimal money, validity flags; one row per input row.

    Values that do not fit the narrow type become null.
    """
    flags = validity_flags()
    typed = [
        F.col(name).try_cast(kind).alias(name)
        for name, kind in K.CORE_CONTRACT.items()
        if name not in _FLAGS and name != "core_processed_timestamp"
    ]
    return trips.select(
        *typed,
        *[flags[name].alias(name) for name in _FLAGS],
        F.current_timestamp().alias("core_processed_timestamp"),
    )


def build_clean(core: DataFrame) -> DataFrame:
    """Complete rows with missing flags, imputed ``*_clean`` twins and a Gold flag."""
    missing = {f"is_{c}_missing": F.col(c).isNull() for c in K.IMPUTE_DEFAULTS}
    twins = {
        f"{c}_clean": F.coalesce(
            F.col(c).cast(K.CORE_CONTRACT[c]), F.lit(default).cast(K.CORE_CONTRACT[c])
        )
        for c, default in K.IMPUTE_DEFAULTS.items()
    }
    candidate = (
        ~F.col("is_outlier_trip")
        & F.col("is_valid_distance")
        & F.col("is_valid_fare")
        & F.col("is_valid_total_amount")
    )
    return (
        core.dropna(subset=K.CORE_REQUIRED)
        .withColumns({**missing, **twins, "is_gold_candidate": candidate})
        .withColumn("clean_processed_timestamp", F.current_timestamp())
    )
