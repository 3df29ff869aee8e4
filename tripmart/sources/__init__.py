"""Scans and sinks."""

from .envelopes import trips_to_envelope, weather_to_envelope
from .readers import (
    collect_small,
    path_status,
    read_jdbc,
    read_metrics,
    read_report,
    read_table,
    read_tagged_union,
    read_zones,
    sample,
    try_read,
)
from .writers import (
    rewrite_partitions,
    write_csv,
    write_jdbc,
    write_partitioned,
    write_report,
)

__all__ = [
    "collect_small", "path_status", "read_jdbc", "read_metrics", "read_report",
    "read_table", "read_tagged_union", "read_zones", "rewrite_partitions", "sample",
    "trips_to_envelope", "try_read", "weather_to_envelope", "write_csv", "write_jdbc",
    "write_partitioned", "write_report",
]
