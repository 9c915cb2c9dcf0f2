"""Duplicate-free series on a complete time grid."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from roadspeed.functions import floor_div, micros, nan_to_null, parse_mixed_ts
from roadspeed.session import materialise

# Slots of a link that form a chunk, and slots that a task makes.
_BLOCK = 1024
_TASK_SLOTS = 250_000


def timed(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """``ts`` as a timestamp; text in mixed formats is parsed, unreadable text becomes NULL."""
    kind = df.schema[ts].dataType.simpleString()
    if kind == "timestamp":
        return df
    return df.withColumn(ts, parse_mixed_ts(ts) if kind == "string" else F.col(ts).cast("timestamp"))


def dedupe_mean(df: DataFrame, keys: Iterable[str], cols: Iterable[str]) -> DataFrame:
    """One row per key with the mean of each column; NULL and NaN are skipped, NULL keys dropped."""
    keys = list(keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(*[F.avg(nan_to_null(F.col(c))).alias(c) for c in cols])


def _tasks(spark: SparkSession, bounds: DataFrame, size: int) -> int:
    """Tasks for all slots: enough to bound a task's share, and with few slots still some for each core."""
    slots = bounds.agg(F.sum(floor_div(F.col("_hi") - F.col("_lo"), size) + 1)).first()[0] or 0
    return max(1, -(-slots // _TASK_SLOTS), min(spark.sparkContext.defaultParallelism, slots // 4096))


def chunked_slots(
    df: DataFrame,
    cols: Iterable[str],
    key: str,
    ts: str,
    size: int,
    chunk: int,
    before: int = 0,
    after: int = 0,
    seen: Observation | None = None,
) -> DataFrame:
    """key, _chunk, _us, columns, _home: all slots, spread by key and time chunk (times in microseconds).

    Only readings are shuffled, once. A chunk's slots are made where its readings have arrived: a reading makes its own slot
    and the empty ones up to the next reading. One marker row for each key and chunk brings the key's first and last time and
    starts the slots before the first reading, so chunks without readings have theirs too. Readings up to ``before`` ahead of
    a chunk and ``after`` behind it come along as copies that are not ``_home`` and make no slots.

    The keys' bounds are written first, as they also tell how many tasks the slots are worth.
    """
    cols = list(cols)
    rows = timed(df.withColumn("_given", F.col(ts).isNotNull()), ts)
    if seen is not None:
        rows = rows.observe(seen, F.count_if(F.col("_given") & F.col(ts).isNull()).alias("unreadable"))
    us = F.col("_us")
    rows = rows.dropna(subset=[key, ts]).select(
        key, F.unix_micros(ts).alias("_us"), *[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols]
    )
    bounds = materialise(rows.groupBy(key).agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi")), "bounds")

    begin = F.col("_chunk") * chunk
    first = F.greatest(F.lit(0).cast("bigint"), F.ceil((begin - F.col("_lo")) / size).cast("bigint"))
    markers = (
        bounds.withColumn("_chunk", F.explode(F.sequence(floor_div(F.col("_lo"), chunk), floor_div(F.col("_hi"), chunk))))
        .withColumn("_us", F.col("_lo") + first * size)
        .filter((us <= F.col("_hi")) & (us < begin + chunk))
    )
    nearby = F.sequence(floor_div(us - after, chunk), floor_div(us + before, chunk))
    placed = rows.withColumn("_chunk", F.explode(nearby) if before or after else floor_div(us, chunk))
    slots = (
        placed.unionByName(markers, allowMissingColumns=True)
        .repartition(_tasks(df.sparkSession, bounds, size), key, "_chunk")
        .groupBy(key, "_chunk", "_us")
        .agg(*[F.avg(c).alias(c) for c in cols], F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("_us")
    whole = in_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    on_grid = (
        slots.withColumns({"_lo": F.max("_lo").over(whole), "_hi": F.max("_hi").over(whole)})
        .filter(F.pmod(us - F.col("_lo"), F.lit(size)) == 0)  # also drops copies in chunks without slots
        .withColumns({"_next": F.lead("_us").over(in_chunk), "_home": (us >= begin) & (us < begin + chunk)})
    )
    end = F.least("_next", begin + chunk, F.col("_hi") + 1)  # NULL, for no next reading, is skipped
    run = F.when(F.col("_home"), F.sequence(us, end - 1, F.lit(size).cast("bigint"))).otherwise(F.array(us))
    return on_grid.select(key, "_chunk", "_us", *cols, "_home", F.explode(run).alias("_slot")).select(
        key, "_chunk", F.col("_slot").alias("_us"), *[F.when(us == F.col("_slot"), F.col(c)).alias(c) for c in cols], "_home"
    )


def complete_grid(
    df: DataFrame,
    cols: Iterable[str],
    key: str = "linkid",
    ts: str = "datetime",
    step: str | timedelta = "5 minutes",
    seen: Observation | None = None,
) -> DataFrame:
    """One row per key and slot between the key's first and last time; absent slots have NULLs.

    The grid starts at each key's own first time, so rows between its slots vanish. Duplicates
    are averaged. ``seen`` gets ``unreadable``, the rows left out because their time can't be read.
    """
    cols, size = list(cols), micros(step)
    slots = chunked_slots(df, cols, key, ts, size, _BLOCK * size, seen=seen)
    return slots.select(key, F.timestamp_micros("_us").alias(ts), *cols)
