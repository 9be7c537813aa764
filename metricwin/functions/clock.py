"""Times of day as text, as seconds, and as timestamps. Independent of the session zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400

# One or two digits per part, hours below 24, an optional fraction of a second.
_TIME_TEXT = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9](\.[0-9]+)?$"


def _parts(ts: Column) -> tuple[Column, Column, Column]:
    # substring_index is several times cheaper per row than split or split_part.
    text = F.trim(ts)
    minute = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    second = F.substring_index(F.substring_index(text, ":", -1), ".", 1)
    return F.substring_index(text, ":", 1), minute, second


def normalised(ts: Column) -> Column:
    """``HH:mm:ss``: pads short parts, trims blanks, cuts a fraction; null if not a time."""
    text = F.concat_ws(":", *[F.lpad(p, 2, "0") for p in _parts(ts)])
    return F.when(F.trim(ts).rlike(_TIME_TEXT), text)


def seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight of a time-of-day text, null if it is not one."""
    hour, minute, second = (p.try_cast("long") for p in _parts(ts))
    return F.when(F.trim(ts).rlike(_TIME_TEXT), hour * 3600 + minute * 60 + second)


def on_epoch_day(ts: Column) -> Column:
    """The time of day as a timestamp on 1970-01-01 UTC."""
    return F.timestamp_seconds(seconds_of_day(ts))


def on_day(ts: Column, day: date) -> Column:
    """The time of day as a timestamp on a given day, UTC; null if it is no time."""
    start = (day - date(1970, 1, 1)).days * DAY
    return F.timestamp_seconds(seconds_of_day(ts) + start)


def clock_text(seconds: Column) -> Column:
    """``HH:mm:ss`` of a number of seconds, wrapping at midnight in both directions."""
    s = F.pmod(seconds.cast("long"), F.lit(DAY))
    parts = (F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def date_clock_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC of seconds since 1970-01-01."""
    day = F.date_from_unix_date(F.floor(seconds / DAY).cast("int"))
    return F.concat_ws(" ", day.cast("string"), clock_text(seconds))


def nearest_event_time(ts: Column, record_time: Column) -> Column:
    """Put a date on a time of day: the day that brings it nearest to ``record_time``.

    A reading taken just before midnight and recorded just after it keeps its own day, so
    the result runs on across midnight and can carry a watermark. Null if ``ts`` is no time.
    Right only for readings recorded within twelve hours; for others ``on_day`` has to be told.
    """
    record = F.unix_seconds(record_time)
    half = F.lit(DAY // 2)
    gap = F.pmod(seconds_of_day(ts) - F.pmod(record, F.lit(DAY)) + half, F.lit(DAY)) - half
    return F.timestamp_seconds(record + gap)
