"""Time parsing, time parts and calendar flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def parse_local_ts(text: Column) -> Column:
    """Local wall-clock string to timestamp in the session zone; null if unreadable.

    Accepts ``yyyy-MM-dd`` followed by ``T`` or a blank and ``HH:mm``,
    ``HH:mm:ss`` or ``HH:mm:ss.ffffff``.  The cast-based parser understands all
    of these in one attempt, so no chain of per-pattern formatters (each miss of
    which would cost an exception per row) is needed.
    """
    return F.try_to_timestamp(text)


def trunc_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def time_parts(prefix: str, ts: Column) -> dict[str, Column]:
    """Hour bucket, date and ``yyyy-MM`` key, named ``<prefix>_hour`` and so on."""
    return {
        f"{prefix}_hour": trunc_hour(ts),
        f"{prefix}_date": F.to_date(ts),
        f"{prefix}_year_month": F.date_format(ts, "yyyy-MM"),
    }


def _flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("tinyint")


def is_weekend(day: Column, days: Sequence[int]) -> Column:
    return _flag(day.isin(list(days)))


def is_rush_hour(hour: Column) -> Column:
    return _flag(hour.isin(K.RUSH_HOURS))


def is_cold(temperature_f: Column) -> Column:
    return _flag(temperature_f < K.COLD_BELOW_F)


def is_raining(precipitation_mm: Column) -> Column:
    return _flag(precipitation_mm > 0)


def is_holiday(ts: Column, holidays: Sequence[str] = tuple(K.HOLIDAYS)) -> Column:
    dates = [F.lit(d).cast("date") for d in holidays]
    return _flag(F.to_date(ts).isin(dates))


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine position of ``value`` on a circle of length ``period``."""
    angle = value * F.lit(2.0) * F.pi() / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
