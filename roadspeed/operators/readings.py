"""Raw and bronze readings up to the mean per link and slot."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.functions import nan_to_null, pad_day, pad_time, parse_stamp, slot_start

BRONZE_SCHEMA = (
    "CREATDE string, CREATHM string, LINKID string, ROADINSTTCD string, "
    "PASNGSPED double, PASNGTIME double, date string"
)
SILVER_SCHEMA = "datetime timestamp, linkid string, self_mean double, date string"


def to_bronze(raw: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The six raw columns with their types, the day if present, and ``keep``; malformed numbers are NULL."""
    text = ["CREATDE", "CREATHM", "LINKID", "ROADINSTTCD"]
    numbers = ["PASNGSPED", "PASNGTIME"]
    return raw.select(
        *[F.col(c).cast("string") for c in text],
        *[F.col(c).try_cast("double").alias(c) for c in numbers],
        *[c for c in raw.columns if c == "date"],
        *keep,
    )


def filter_links(df: DataFrame, links: DataFrame | Iterable[str] | None, column: str = "LINKID") -> DataFrame:
    """Rows of the allowed links; ``None`` allows all.

    A list becomes an IN predicate that reaches the Parquet scan. A frame (first column) becomes
    a semi join; whether it is broadcast is left to its measured size.
    """
    if links is None:
        return df
    if isinstance(links, DataFrame):
        allowed = links.select(F.col(links.columns[0]).cast("string").alias(column)).distinct()
        return df.join(allowed, column, "left_semi")
    return df.filter(F.col(column).isin(list(links)))


def valid_stamp(df: DataFrame) -> DataFrame:
    """Rows whose padded day and time are all digits."""
    return df.filter(F.col("CREATDE").rlike("^[0-9]{8}$") & F.col("CREATHM").rlike("^[0-9]{4}$"))


def same_day(df: DataFrame) -> DataFrame:
    """Rows that belong to the day they were filed under."""
    return df.filter(F.col("CREATDE") == F.col("date"))


def normalise_time(
    bronze: DataFrame,
    links: DataFrame | Iterable[str] | None = None,
    drop_invalid_time: bool = True,
    keep: Iterable[str] = (),
) -> DataFrame:
    """date, linkid, datetime, speed, and ``keep``, of the usable readings.

    Digits that form no time of day (``2500``) are dropped; with ``drop_invalid_time=False`` they
    are kept with a NULL ``datetime``.
    """
    narrow = filter_links(bronze, links).select(
        pad_day("CREATDE").alias("CREATDE"),
        pad_time("CREATHM").alias("CREATHM"),
        F.col("LINKID").alias("linkid"),
        nan_to_null(F.col("PASNGSPED")).alias("speed"),
        "date",
        *keep,
    )
    timed = same_day(valid_stamp(narrow)).select(
        "date", "linkid", parse_stamp("CREATDE", "CREATHM").alias("datetime"), "speed", *keep
    )
    return timed.filter("datetime IS NOT NULL") if drop_invalid_time else timed


def slot_mean(
    df: DataFrame,
    keys: Iterable[str] = ("date", "linkid"),
    ts: str = "datetime",
    value: str = "speed",
    step: str | timedelta = "5 minutes",
    out: str = "self_mean",
) -> DataFrame:
    """Mean value per key and slot. One shuffle of map-side partial means, so a hot link is cheap."""
    slot: Column = slot_start(ts, step).alias(ts)
    return df.groupBy(slot, *keys).agg(F.avg(value).alias(out))


def slot_sums(
    df: DataFrame,
    keys: Iterable[str] = ("date", "linkid", "source"),
    ts: str = "datetime",
    value: str = "speed",
    step: str | timedelta = "5 minutes",
) -> DataFrame:
    """Total and number of the values per key and slot. Such rows of several sources add up to their common mean."""
    return df.groupBy(slot_start(ts, step).alias(ts), *keys).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"), F.count(value).alias("n")
    )


def merged_mean(
    sums: DataFrame, keys: Iterable[str] = ("date", "linkid"), ts: str = "datetime", out: str = "self_mean"
) -> DataFrame:
    """The mean per key and slot from any number of ``slot_sums``; NULL where no value was read."""
    total = sums.groupBy(ts, *keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return total.select(ts, *keys, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias(out))
