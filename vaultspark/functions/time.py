"""Time helpers.  All warehouse times are zone-less (``timestamp_ntz``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse model.
OPEN_TO = "2099-12-01 00:00:00"      # active_to of the open (current) version
LOW_WATERMARK = "1900-01-01 00:00:00"  # watermark when a collection has no log row
LOCAL_ZONE = "Europe/Moscow"          # zone that defines the run date

DayLike = str | dt.date


def ts_lit(value: str | dt.datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def day_lit(day: DayLike) -> Column:
    return F.lit(str(day)).cast("date")


def _day(day: DayLike) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


def in_days(col: Column | str, lo: DayLike, hi: DayLike | None = None) -> Column:
    """``col::date BETWEEN lo AND hi`` written as a half-open range on ``col``.

    For a timestamp column this is the same predicate, but it reaches the
    parquet reader as two pushed comparisons (row-group and partition pruning).
    For a date column it is a plain range too.
    """
    c = F.col(col) if isinstance(col, str) else col
    lo_d = _day(lo)
    hi_d = _day(hi if hi is not None else lo) + dt.timedelta(days=1)
    return (c >= ts_lit(f"{lo_d} 00:00:00")) & (c < ts_lit(f"{hi_d} 00:00:00"))


def on_day(col: Column | str, day: DayLike) -> Column:
    """``col::date = day``."""
    return in_days(col, day, day)


def text_day(col: Column | str) -> Column:
    """Date of a timestamp written as text (``'2024-01-05 10:00:00'``); ANSI cast, so bad text fails."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("date")


def minus_one_ms(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c - F.expr("INTERVAL '0.001' SECOND")


def local_day(col: Column | str, zone: str = LOCAL_ZONE, source_zone: str = "UTC") -> Column:
    """Calendar date in ``zone`` of a zone-less instant recorded in ``source_zone``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.convert_timezone(F.lit(source_zone), F.lit(zone), c))


def previous_day(day: DayLike, days: int = 1) -> dt.date:
    return _day(day) - dt.timedelta(days=days)
