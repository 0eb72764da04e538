"""Calendar parts of a pickup time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Peak hours of the training features and of the factor scorer.
TRAINING_PEAK_HOURS = (7, 8, 9, 16, 17, 18, 19)
FACTOR_PEAK_HOURS = (7, 8, 9, 17, 18, 19)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pickup_hour(ts: Column | str) -> Column:
    return F.hour(_col(ts))


def pickup_weekday(ts: Column | str) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_col(ts))


def pickup_month(ts: Column | str) -> Column:
    return F.month(_col(ts))


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday … 7 = Sunday."""
    return (F.weekday(_col(ts)) + 1).cast("int")


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(_col(ts)).isin(1, 7).cast("int")


def is_peak(hour: Column | str, hours: Iterable[int] = TRAINING_PEAK_HOURS) -> Column:
    return _col(hour).isin(*hours).cast("int")


def pickup_timestamp(date: Column | str, time: Column | str) -> Column:
    """Wall-clock pickup time from a date and an ``HH:mm:ss`` time; NULL if either does not parse."""
    text = F.concat(_col(date).cast("string"), F.lit(" "), _col(time).cast("string"))
    return text.try_cast("timestamp_ntz")


def timestamp_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock time. ``date_format`` would read it in
    the session zone first and move times that a clock change skips."""
    return F.substring(_col(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def date_text(ts: Column | str) -> Column:
    return F.substring(timestamp_text(ts), 1, 10)


def time_text(ts: Column | str) -> Column:
    return F.substring(timestamp_text(ts), 12, 8)
