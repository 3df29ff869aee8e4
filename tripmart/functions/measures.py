"""Ratios, weighted averages and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EARTH_RADIUS_MILES


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null when either side is missing or the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def weighted_avg(value: Column, weight: Column) -> Column:
    """Aggregate: re-average pre-aggregated averages by their row counts."""
    return F.try_divide(
        F.sum(value.cast("double") * weight), F.sum(weight).cast("double")
    )


def decimal_avg(money: Column) -> Column:
    """Aggregate: mean of a decimal column as double.

    The sum stays decimal, so the result does not depend on how rows were
    partitioned; only the final division is floating point.
    """
    return F.try_divide(F.sum(money).cast("double"), F.count(money).cast("double"))


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def percent_change(current: Column, previous: Column) -> Column:
    return F.try_divide((current - previous).cast("double"), previous.cast("double")) * 100


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles between two WGS84 points in degrees."""
    half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), 2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))
