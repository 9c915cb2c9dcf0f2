"""Time-based train/validation split and small summaries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.functions import floor_div, micros

_DAY = micros("1 day")
_SMALL = 100_000


def to_micros(moment: datetime | int) -> int:
    """Epoch microseconds; a datetime without zone is UTC."""
    if isinstance(moment, int):
        return moment
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    delta = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def at(moment: datetime | int) -> Column:
    """A timestamp literal that does not depend on the driver's local time zone."""
    return F.timestamp_micros(F.lit(to_micros(moment)))


def within(ts: str, moments: tuple[datetime | int, datetime | int]) -> Column:
    return F.col(ts).between(at(moments[0]), at(moments[1]))


def time_span(df: DataFrame, *by: str, ts: str = "datetime") -> DataFrame:
    """First and last time and the number of whole days in between plus one."""
    first, last = F.min(ts), F.max(ts)
    days = floor_div(F.unix_micros(last) - F.unix_micros(first), _DAY) + 1
    return df.groupBy(*by).agg(first.alias("first"), last.alias("last"), days.cast("int").alias("total_days"))


def row_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def restrict_links(df: DataFrame, train: DataFrame, key: str = "linkid") -> DataFrame:
    """Rows of links that occur in train."""
    return df.join(train.select(key).distinct(), key, "left_semi")


@dataclass(frozen=True)
class Split:
    """A cut in (time, link) order, links compared as text whatever their type.

    Both sides are plain filters, so applying it shuffles nothing.
    """

    cut: int
    cut_link: str | None = None
    key: str = "linkid"
    ts: str = "datetime"

    @property
    def in_train(self) -> Column:
        ts, cut = F.col(self.ts), at(self.cut)
        if self.cut_link is None:
            return ts < cut
        return (ts < cut) | ((ts == cut) & (F.col(self.key).cast("string") <= F.lit(self.cut_link)))

    def train(self, df: DataFrame) -> DataFrame:
        return df.filter(self.in_train)

    def validation(self, df: DataFrame) -> DataFrame:
        return df.filter(~self.in_train)


def split_by_time(
    df: DataFrame,
    val_days: int = 30,
    train_frac: float = 0.8,
    key: str = "linkid",
    ts: str = "datetime",
    small: int = _SMALL,
) -> Split:
    """The last ``val_days`` days are validation; a period too short for that is cut by rows.

    By rows: the first ``train_frac`` (at least one row) in (time, link) order. ``df`` has one row
    per link and time. An empty side raises ValueError.
    """
    total, first, last = df.agg(
        F.count(ts), F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))
    ).first()
    if not total:
        raise ValueError("nothing to split")
    if (last - first) // _DAY + 1 > val_days:
        split = Split(last - val_days * _DAY, None, key, ts)
        if first >= split.cut:
            raise ValueError(f"empty train side: rows={total}, val_days={val_days}")
        return split
    size = max(1, int(total * train_frac))
    if size >= total:
        raise ValueError(f"empty validation side: rows={total}, train={size}")
    rows = df.select(ts, F.col(key).cast("string").alias(key)).filter(F.col(ts).isNotNull())
    cut, link = _nth_row(rows, size, total, key, ts, small)
    return Split(cut, link, key, ts)


def _nth_row(rows: DataFrame, n: int, total: int, key: str, ts: str, small: int) -> tuple[int, str]:
    """Time and link of the n-th row (1-based) in (time, link) order, without a global sort.

    Rows are counted per day, then per minute and second of the day that holds the row, then per
    link prefix; every step is a map-side combined count over a narrower time range. Only when
    few candidates are left are they sorted.
    """

    def narrow(bucket: Column) -> object:
        """Value of the bucket that holds the n-th row; makes n and total relative to it."""
        nonlocal n, total
        for value, count in rows.groupBy(bucket.alias("b")).count().orderBy("b").collect():
            if n <= count:
                total = count
                return value
            n -= count
        raise AssertionError("row number beyond the last row")

    for width in (_DAY, micros("1 minute"), micros("1 second"), 1_000, 1):
        if total <= small:
            break
        bucket = narrow(floor_div(F.unix_micros(ts), width))
        rows = rows.filter((F.col(ts) >= at(bucket * width)) & (F.col(ts) < at((bucket + 1) * width)))
    length = 1
    while total > small:
        head = narrow(F.substring(key, 1, length))
        rows = rows.filter(F.substring(key, 1, length) == F.lit(head))
        if len(head) < length:
            raise ValueError(f"more than one row per {key} and {ts}")
        length += 1
    last, *following = rows.orderBy(ts, key).offset(n - 1).limit(2).select(F.unix_micros(ts), key).collect()
    if following and following[0] == last:
        raise ValueError(f"more than one row per {key} and {ts}")
    return last[0], last[1]
