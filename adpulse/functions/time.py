"""Time helpers whose results do not depend on the session time zone."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: layout of the event time text.
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"
_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def event_time(text: Column, zone: str) -> Column:
    """Strictly parsed instant of an offset-less text written in ``zone`` (a fixed offset such as +02:00);
    NULL when the text does not match the pattern."""
    return F.try_to_timestamp(F.concat(text, F.lit(zone)), F.lit(EVENT_TIME_PATTERN + "XXX"))


def wall_clock(instant: Column, zone: str) -> Column:
    """Instant -> local date and time in ``zone``, as a zone-free timestamp."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def calendar_day(table: DataFrame, column: str = "window_start") -> Column:
    """Date of ``table[column]``: as written for zone-free times, in UTC for instants (never the session's day)."""
    return F.to_date(F.col(column) if is_zone_free(table, column) else wall_clock(F.col(column), "UTC"))


def time_of_day(local: Column) -> Column:
    return F.date_format(local, "HH:mm:ss")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with fraction."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / 1e6


def interval_micros(text: str) -> int:
    """Length of a fixed interval such as ``10 seconds`` or ``1 day 6 hours``."""
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text)
    if not parts or re.sub(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", "", text).strip():
        raise ValueError(f"not an interval: {text!r}")
    total = 0
    for count, unit in parts:
        name = unit.lower().rstrip("s")
        if name not in _UNITS:
            raise ValueError(f"unit {unit!r} of {text!r} has no fixed length")
        total += round(float(count) * _UNITS[name])
    return total


def is_zone_free(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def instant_micros(table: DataFrame, column: str) -> Column:
    """Microseconds since the epoch; zone-free times count as UTC."""
    if is_zone_free(table, column):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(column))
    return F.unix_micros(column)


def moment(value: datetime | str, like: DataFrame, column: str = "window_start") -> Column:
    """Literal of the same timestamp kind as ``like[column]``, so comparisons need no cast on the column and
    stay pushable. Zone-aware datetimes are reduced to UTC for zone-free columns."""
    if is_zone_free(like, column):
        if isinstance(value, datetime):
            value = (value.astimezone(timezone.utc) if value.tzinfo else value).strftime("%Y-%m-%d %H:%M:%S.%f")
        elif _has_offset(value):
            raise ValueError(f"{column} is zone-free: give a time without an offset, not {value!r}")
        return F.lit(value).cast("timestamp_ntz")
    if isinstance(value, datetime):
        # An explicit offset keeps the literal independent of the session zone; naive means UTC.
        aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        value = aware.isoformat(sep=" ")
    elif not _has_offset(value):
        value = f"{value}+00:00"
    return F.lit(value).cast("timestamp")


def _has_offset(text: str) -> bool:
    return text.endswith("Z") or "+" in text[10:] or "-" in text[10:]
