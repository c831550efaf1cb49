"""Event-time helpers.  Event times are `timestamp_ntz` in batch and `timestamp` (UTC) in streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date format of access-log lines.
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def span_us(text: str) -> int:
    """'15 minutes 1 millisecond' -> microseconds."""
    words = text.split()
    return sum(
        int(n) * _UNIT_US[unit.removesuffix("s")] for n, unit in zip(words[::2], words[1::2], strict=True)
    )


def interval(text: str) -> Column:
    """The same text as a day-time interval column."""
    return F.expr(f"INTERVAL '{span_us(text)}' MICROSECOND")


def to_micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def from_epoch_seconds(seconds: Column | str) -> Column:
    return F.timestamp_seconds(seconds)


def window_start(ts: Column | str, size: str) -> Column:
    """Start of the tumbling window of a row, aligned to the epoch."""
    us = to_micros(ts)
    return from_micros(us - F.pmod(us, F.lit(span_us(size))))


def next_midnight(ts: Column) -> Column:
    return F.date_trunc("day", ts) + interval("1 day")


def day_number(ts: Column) -> Column:
    """Days since the epoch, UTC."""
    return F.unix_date(ts.cast("date")).cast("long")


def parse_log_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(LOG_TIME_FORMAT))
