"""Gap filling: moving mean first, seasonal mean for what remains."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspeed.functions import floor_div, micros, minute_of_day, nan_to_null
from roadspeed.operators.grid import _BLOCK, chunked_slots, timed

_DAY = micros("1 day")
_FRAMES_PER_CHUNK = 64


def _reach(span: int) -> tuple[int, int]:
    """How far a frame (t - width/2, t + width/2] reaches back and ahead, in microseconds."""
    return span - span // 2 - 1, span // 2


def impute_rolling(
    df: DataFrame,
    cols: Iterable[str],
    key: str = "linkid",
    ts: str = "datetime",
    width: str | timedelta = "31 minutes",
) -> DataFrame:
    """Fill NULLs with the mean over (t - width/2, t + width/2] of the unfilled column.

    A series is cut into time chunks and every row is copied to the chunks its neighbours lie in,
    so a window holds one chunk, not a whole link. A chunk is at least 64 frames long, so few rows
    are copied.
    """
    cols = list(cols)
    span = micros(width)
    before, after = _reach(span)
    chunk = max(_DAY, _FRAMES_PER_CHUNK * span)
    us = F.col("_us")
    home = floor_div(us, chunk)
    spread = (
        timed(df, ts).dropna(subset=[key, ts])
        .withColumns({"_us": F.unix_micros(ts), **{c: nan_to_null(F.col(c)) for c in cols}})
        .withColumn("_chunk", F.explode(F.sequence(floor_div(us - after, chunk), floor_div(us + before, chunk))))
    )
    frame = Window.partitionBy(key, "_chunk").orderBy("_us").rangeBetween(-before, after)
    return (
        spread.withColumns({f"_mean_{c}": F.avg(c).over(frame) for c in cols})
        .filter(F.col("_chunk") == home)
        .withColumns({c: F.coalesce(c, f"_mean_{c}") for c in cols})
        .select(df.columns)
    )


def impute_seasonal(df: DataFrame, cols: Iterable[str], key: str = "linkid", ts: str = "datetime") -> DataFrame:
    """Fill NULLs with the mean of the same link, weekday and time of day.

    One shuffle and no join. On a grid of minutes or more a group has at most one row per week of
    the period, however hot the link is.
    """
    cols = list(cols)
    season = Window.partitionBy(key, F.weekday(ts), minute_of_day(ts))
    return (
        timed(df, ts).dropna(subset=[key, ts])
        .withColumns({c: nan_to_null(F.col(c)) for c in cols})
        .withColumns({f"_mean_{c}": F.avg(c).over(season) for c in cols})
        .withColumns({c: F.coalesce(c, f"_mean_{c}") for c in cols})
        .select(df.columns)
    )


def impute(
    df: DataFrame,
    cols: Iterable[str],
    key: str = "linkid",
    ts: str = "datetime",
    step: str | timedelta = "5 minutes",
    width: str | timedelta = "31 minutes",
) -> DataFrame:
    """Complete grid, then both fills. Seasonal means include the values the moving mean filled in.

    The moving mean runs where the slots are made, as each chunk has copies of the readings around it. So the readings are
    shuffled once, and the slots once for the seasonal mean.
    """
    cols, size, span = list(cols), micros(step), micros(width)
    before, after = _reach(span)
    slots = chunked_slots(df, cols, key, ts, size, max(_BLOCK * size, _FRAMES_PER_CHUNK * span), before, after)
    frame = Window.partitionBy(key, "_chunk").orderBy("_us").rangeBetween(-before, after)
    rolled = (
        slots.withColumns({f"_mean_{c}": F.avg(c).over(frame) for c in cols})
        .filter("_home")
        .select(key, F.timestamp_micros("_us").alias(ts), *[F.coalesce(c, f"_mean_{c}").alias(c) for c in cols])
    )
    return impute_seasonal(rolled, cols, key, ts)
