"""Code-to-label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _lookup(code: Column, labels: Mapping[int, str]) -> Column:
    """Map literal lookup; a missing key or null code gives null."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def weather_description(code: Column) -> Column:
    """WMO code to text; unknown codes are labelled, a null code stays null."""
    return F.when(
        code.isNotNull(),
        F.coalesce(_lookup(code, K.WMO_DESCRIPTIONS), F.lit(K.UNKNOWN_WEATHER)),
    )


def payment_label(code: Column) -> Column:
    fallback = F.concat(F.lit("Type "), code.cast("int").cast("string"))
    return F.coalesce(_lookup(code, K.PAYMENT_LABELS), fallback)


def zone_display_name(zone_id: Column) -> Column:
    fallback = F.concat(F.lit("Zone "), zone_id.cast("string"))
    return F.coalesce(_lookup(zone_id, K.FORECAST_ZONE_NAMES), fallback)


def is_airport(zone_id: Column) -> Column:
    return F.coalesce(zone_id.isin(K.AIRPORT_ZONES), F.lit(False)).cast("tinyint")


def is_core_zone(zone_id: Column) -> Column:
    return F.coalesce(zone_id.isin(K.CORE_ZONES), F.lit(False)).cast("tinyint")


def zone_type(airport: Column, core: Column) -> Column:
    """Label from the two 0/1 flags; core wins when both are set."""
    return (
        F.when(core == 1, K.ZONE_TYPE_LABELS["core"])
        .when(airport == 1, K.ZONE_TYPE_LABELS["airport"])
        .otherwise(K.ZONE_TYPE_LABELS["normal"])
    )


def day_label(day_name: Column) -> Column:
    """Display label of an English day name; unknown names pass through."""
    pairs = [F.lit(part) for item in K.DAY_LABELS.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), day_name), day_name)
