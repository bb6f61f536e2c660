"""Time codes: ``yyyyMMddHHmmss`` digits, epoch seconds, and day / hour / month tags.

Parsing is strict and in the session time zone (UTC, see ``session.RUNTIME_CONF``). A value
that is not a time gives NULL, or 0 where the sinks expect a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the event feed and of the table layout.
DIGIT_TIME = "yyyyMMddHHmmss"
HOUR_TAG = "yyyyMMddHH"
DAY_TAG = "yyyyMMdd"
MONTH_TAG = "yyyyMM"


def parse_time(digits: Column) -> Column:
    """Digits (number or string) to TIMESTAMP; NULL when they are not a time."""
    return F.try_to_timestamp(digits.cast("string"), F.lit(DIGIT_TIME))


def parse_date(digits: Column) -> Column:
    return F.to_date(parse_time(digits))


def epoch_seconds(digits: Column) -> Column:
    """Digits to epoch seconds; 0 when they are not a time."""
    return F.coalesce(F.unix_timestamp(parse_time(digits)), F.lit(0).cast("bigint"))


def day_id(digits: Column) -> Column:
    """Digits to the INT day ``yyyyMMdd``; 0 when they are not a time."""
    return F.coalesce(F.date_format(parse_time(digits), DAY_TAG).cast("int"), F.lit(0))


def day_of(seconds: Column) -> Column:
    """Epoch seconds to the INT day ``yyyyMMdd``."""
    return F.date_format(F.timestamp_seconds(seconds), DAY_TAG).cast("int")


def hour_tag(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), HOUR_TAG)


def month_tag(seconds: Column, now: Column | None = None) -> Column:
    """Epoch seconds to ``yyyyMM``; the current month when there is no positive time."""
    current = F.current_timestamp() if now is None else now
    known = F.date_format(F.timestamp_seconds(seconds), MONTH_TAG)
    return F.when(seconds > 0, known).otherwise(F.date_format(current, MONTH_TAG))


def shift_day(day: Column, days: int) -> Column:
    """A DATE moved by ``days`` as the ``yyyyMMdd`` tag."""
    return F.date_format(F.date_add(day, days), DAY_TAG)


def shift_hour_tag(tag: Column, days: int) -> Column:
    """A ``yyyyMMddHH`` tag moved by whole days; NULL when it is not a tag."""
    moved = F.try_to_timestamp(tag, F.lit(HOUR_TAG)) + F.make_interval(days=F.lit(days))
    return F.date_format(moved, HOUR_TAG)


def reformat(text: Column, source: str, target: str) -> Column:
    return F.date_format(F.try_to_timestamp(text, F.lit(source)), target)


def naive_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ; the session zone is UTC."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("SECOND", origin, ts)
