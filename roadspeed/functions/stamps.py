"""Column expressions on days, times and intervals (the session runs in UTC)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"

_UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

# Accepted spellings of a timestamp, tried in this order.
MIXED_FORMATS = (
    "yyyy-MM-dd[ ]['T']HH:mm[:ss][.SSSSSS]",
    "yyyy-MM-dd",
    "yyyyMMddHHmmss",
    "yyyyMMddHHmm",
    "yyyyMMdd",
    "yyyy/MM/dd HH:mm[:ss]",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm[:ss]",
    "MM/dd/yyyy",
)


def micros(interval: str | timedelta) -> int:
    """Microseconds of ``"5 minutes"`` or of a timedelta."""
    if isinstance(interval, timedelta):
        size = interval // timedelta(microseconds=1)
    else:
        number, unit = interval.split()
        size = int(number) * _UNIT_MICROS[unit.rstrip("s")]
    if size <= 0:
        raise ValueError(f"interval must be positive: {interval!r}")
    return size


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_day(c: Column | str) -> Column:
    """Eight characters; a longer value is cut, as left-padding does."""
    return F.lpad(_col(c), 8, "0")


def pad_time(c: Column | str) -> Column:
    return F.lpad(_col(c), 4, "0")


def parse_stamp(day: Column | str, time: Column | str) -> Column:
    """``yyyyMMdd`` and ``HHmm`` to a timestamp; an impossible time is NULL.

    Spelled out as ISO text and cast, which costs less than half of a pattern.
    """
    day, time = _col(day), _col(time)
    dash, colon = F.lit("-"), F.lit(":")
    text = F.concat(
        day.substr(1, 4), dash, day.substr(5, 2), dash, day.substr(7, 2), F.lit(" "), time.substr(1, 2), colon, time.substr(3, 2)
    )
    return F.when(F.length(day) + F.length(time) == 12, text.try_cast("timestamp"))


def parse_mixed_ts(c: Column | str, formats: tuple[str, ...] = MIXED_FORMATS) -> Column:
    """The first format that fits the trimmed text, else what a cast reads (zones, nanoseconds, short fields).

    NULL when nothing does.
    """
    text = F.trim(_col(c))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats], text.try_cast("timestamp"))


def floor_div(c: Column | str, n: int) -> Column:
    """Whole-number division that rounds down, exact for any epoch (a double quotient is not)."""
    c = _col(c)
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def slot_start(ts: Column | str, step: str | timedelta = "5 minutes") -> Column:
    """Start of the tumbling slot holding ``ts``; NULL stays NULL (unlike ``window``, which drops the row)."""
    us = F.unix_micros(_col(ts))
    return F.timestamp_micros(us - F.pmod(us, F.lit(micros(step))))


def minute_of_day(ts: Column | str) -> Column:
    """0..1439, one-to-one with the HH:MM text but without formatting it."""
    ts = _col(ts)
    return F.hour(ts) * 60 + F.minute(ts)


def day_from_path(path: Column | str) -> Column:
    """Day in a file name such as ``20251113_5Min.zip``, else ``unknown_date``."""
    name = F.regexp_extract(F.rtrim(_col(path), F.lit("/")), "([^/]*)$", 1)
    head = F.when(F.contains(name, F.lit("_")), F.substring_index(name, "_", 1)).otherwise(
        F.substring_index(name, ".", 1)
    )
    return F.when(head.rlike("^[0-9]{8}$"), head).otherwise(F.lit("unknown_date"))


def trailing_range(day: Column | str, days: Column | int) -> tuple[Column, Column]:
    """First and last day (``yyyyMMdd``) of the ``days`` days that end with ``day``; at least one day."""
    day = _col(day)
    count = F.lit(days) if isinstance(days, int) else days
    last = F.to_date(day, DAY_FORMAT)
    first = F.date_sub(last, (F.greatest(count, F.lit(1)) - 1).cast("int"))
    return F.date_format(first, DAY_FORMAT), F.date_format(last, DAY_FORMAT)
