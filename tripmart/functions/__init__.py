"""Column expressions: plain functions from Column to Column, no UDFs."""

from .calendar import (
    cyclical,
    is_cold,
    is_holiday,
    is_raining,
    is_rush_hour,
    is_weekend,
    parse_local_ts,
    time_parts,
    trunc_hour,
)
from .hashing import portable_bucket
from .labels import (
    day_label,
    is_airport,
    is_core_zone,
    payment_label,
    weather_description,
    zone_display_name,
    zone_type,
)
from .measures import (
    decimal_avg,
    haversine_miles,
    percent_change,
    round_even,
    safe_ratio,
    weighted_avg,
)

__all__ = [
    "cyclical", "day_label", "decimal_avg", "haversine_miles", "is_airport", "is_cold",
    "is_core_zone", "is_holiday", "is_raining", "is_rush_hour", "is_weekend",
    "parse_local_ts", "payment_label", "percent_change", "portable_bucket", "round_even",
    "safe_ratio", "time_parts", "trunc_hour", "weather_description", "weighted_avg", "zone_display_name", "zone_type",
]
