"""Means, deviations and percentiles over the trailing days of every day, from one summary per day.

Moments are kept per key and day as (n, mean, m2), m2 being the sum of squared distances from the mean. They can be added
and taken away again, so moving a range by a day needs the day that enters and the day that leaves. Percentiles are kept as
one quantile sketch per day; merged sketches bracket the wanted ranks, and only values inside the bracket are sorted.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspeed.functions import nan_to_null
from roadspeed.versions import VersionedDays

_PARTS = ("n", "mean", "m2")
_SKETCH = 4096  # accuracy of a sketch: ranks are off by about a thousandth at most, and
_MARGIN = 0.004  # brackets reach this share of the ranks further


def daily_moments(df: DataFrame, cols: Iterable[str], key: str = "linkid", ts: str = "datetime") -> DataFrame:
    """key, day, and ``<col>_n``, ``<col>_mean``, ``<col>_m2``; NULL and NaN are skipped."""
    parts = []
    for c in cols:
        value = nan_to_null(F.col(c))
        n = F.count(value)
        parts += [
            n.alias(f"{c}_n"), F.coalesce(F.avg(value), F.lit(0.0)).alias(f"{c}_mean"),
            F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias(f"{c}_m2"),
        ]
    return df.groupBy(key, F.to_date(ts).alias("day")).agg(*parts)


def _about(c: str, centre: Column) -> list[Column]:
    """Count, sum and sum of squares about a centre; these add up and are taken away as they are."""
    n, off = F.col(f"{c}_n"), F.col(f"{c}_mean") - centre
    return [n, n * off, F.col(f"{c}_m2") + n * off * off]


def _moments(c: str, centre: Column, n: Column, total: Column, squares: Column) -> list[Column]:
    some = F.when(n > 0, n)
    mean = F.coalesce(centre + total / some, F.lit(0.0))
    m2 = F.greatest(F.coalesce(squares - total * total / some, F.lit(0.0)), F.lit(0.0))
    return [x.alias(f"{c}_{part}") for part, x in zip(_PARTS, (n.cast("bigint"), mean, m2))]


def trailing_moments(daily: DataFrame, cols: Iterable[str], days: int = 30, key: str = "linkid") -> DataFrame:
    """key, day and moments over the ``days`` days up to each of the key's days. A key's window holds a row for each day."""
    of_key = Window.partitionBy(key)
    span = of_key.orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    out = [F.col(key), F.col("day")]
    for c in cols:
        centre = F.avg(f"{c}_mean").over(of_key)
        daily = daily.withColumn(f"_{c}", centre)
        sums = [F.sum(x).over(span) for x in _about(c, F.col(f"_{c}"))]
        daily = daily.withColumns({f"_{c}_{i}": x for i, x in enumerate(sums)})
        out += _moments(c, F.col(f"_{c}"), *(F.col(f"_{c}_{i}") for i in range(3)))
    return daily.select(out)


def deviation(c: str) -> Column:
    """The population deviation of moments."""
    return F.sqrt(F.col(f"{c}_m2") / F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_n")))


def shifted(state: DataFrame, enters: DataFrame, leaves: DataFrame, cols: Iterable[str], key: str = "linkid") -> DataFrame:
    """The moments of a range moved on: one day's are added and another's taken away. Keys without a value are left out."""
    cols = list(cols)
    names = [f"{c}_{part}" for c in cols for part in _PARTS]
    signed = [df.select(key, *names, F.lit(sign).alias("_sign")) for df, sign in ((state, 1), (enters, 1), (leaves, -1))]
    rows = signed[0].unionByName(signed[1]).unionByName(signed[2])
    rows = rows.withColumns({f"_{c}": F.max(f"{c}_mean").over(Window.partitionBy(key)) for c in cols})  # three rows a key
    sums = [F.sum(F.col("_sign") * x).alias(f"_{c}_{i}") for c in cols for i, x in enumerate(_about(c, F.col(f"_{c}")))]
    total = rows.groupBy(key).agg(*[F.first(f"_{c}").alias(f"_{c}") for c in cols], *sums)
    out = [x for c in cols for x in _moments(c, F.col(f"_{c}"), *(F.col(f"_{c}_{i}") for i in range(3)))]
    kept = " + ".join(f"{c}_n" for c in cols)
    return total.select(key, *out).filter(f"{kept} > 0")


class TrailingState:
    """Moments of the ``days`` days up to a day, kept and moved on day by day.

    A move reads the kept state and two days. As rounding adds up over many moves, ``rebuild`` computes a state anew.
    """

    def __init__(
        self, spark: SparkSession, base: str, cols: Iterable[str], days: int = 30, key: str = "linkid", kind: str = "string"
    ) -> None:
        self.cols, self.days, self.key = list(cols), days, key
        self.schema = f"{key} {kind}, " + ", ".join(
            f"{c}_n bigint, {c}_mean double, {c}_m2 double" for c in self.cols
        ) + ", date string"
        self.daily, self.states = VersionedDays(spark, f"{base}/daily"), VersionedDays(spark, f"{base}/states")

    def put(self, df: DataFrame, ts: str = "datetime") -> None:
        """Keep the moments of the days found in the rows; a day that was there is replaced, and states that held it are not."""
        moments = daily_moments(df, self.cols, self.key, ts)
        self.daily.write(moments.withColumn("date", F.date_format("day", "yyyyMMdd")).drop("day"))

    @staticmethod
    def _before(day: str, days: int) -> str:
        return (datetime.strptime(day, "%Y%m%d") - timedelta(days=days)).strftime("%Y%m%d")

    def _on(self, day: str) -> DataFrame:
        return self.daily.read(day, day, self.schema)

    def rebuild(self, day: str) -> DataFrame:
        """The state of the day from all its days."""
        span = self.daily.read(self._before(day, self.days - 1), day, self.schema)
        last = F.to_date(F.lit(day), "yyyyMMdd")
        whole = trailing_moments(
            span.withColumn("day", F.to_date("date", "yyyyMMdd")), self.cols, self.days, self.key
        )
        newest = Window.partitionBy(self.key).orderBy(F.desc("day"))
        latest = whole.filter(F.col("day") <= last).withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
        return self._keep(latest, day)

    def advance(self, day: str) -> DataFrame:
        """The state of the day from that of the day before, if it is kept."""
        yesterday = self._before(day, 1)
        if yesterday not in self.states.days():
            return self.rebuild(day)
        before = self.states.read(yesterday, yesterday, self.schema)
        return self._keep(shifted(before, self._on(day), self._on(self._before(day, self.days)), self.cols, self.key), day)

    def _keep(self, state: DataFrame, day: str) -> DataFrame:
        names = [self.key, *(f"{c}_{part}" for c in self.cols for part in _PARTS)]
        self.states.write(state.select(*names).withColumn("date", F.lit(day)), [day])
        return self.states.read(day, day, self.schema).drop("date")


def daily_sketches(df: DataFrame, value: str, ts: str = "datetime") -> DataFrame:
    """day, n and a quantile sketch of the day's values; NULL and NaN are skipped."""
    y = nan_to_null(F.col(value).cast("double"))
    rows = df.select(F.to_date(ts).alias("day"), y.alias("y")).filter("y IS NOT NULL")
    return rows.groupBy("day").agg(F.count("y").alias("n"), F.kll_sketch_agg_double("y", F.lit(_SKETCH)).alias("sketch"))


def _until(days: int, last: str) -> Column:
    """The days whose range of ``days`` days holds ``day``."""
    return F.explode(F.sequence("day", F.date_add("day", days - 1))).alias(last)


def trailing_percentiles(
    df: DataFrame, sketches: DataFrame, pct: float, value: str, days: int = 30, ts: str = "datetime"
) -> DataFrame:
    """day, n and the exact percentile (linear interpolation) over the ``days`` days up to each day of ``sketches``.

    The merged sketches of a range say between which two values the wanted ranks lie. Values below are counted, values in
    between are numbered, and a range whose ranks are not in its bracket (sketches are right with high probability) is
    searched without one. Brackets have a row for each day of the calendar.
    """
    merged = (
        sketches.select(_until(days, "last"), "n", "sketch").groupBy("last")
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
        .join(sketches.select(F.col("day").alias("last")), "last", "left_semi")
    )
    rank = F.lit(pct / 100) * (F.col("n") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    ends = merged.withColumns({"rank": rank, "low": low, "high": high})
    # With few values the margin is less than a rank, and the bracket is left open.
    many = F.col("n") * _MARGIN > 4

    def aimed(share: float, beyond: float) -> Column:
        if not 0 < share < 1:
            return F.lit(beyond)
        return F.when(many, F.kll_sketch_get_quantile_double("sketch", F.lit(share))).otherwise(beyond)

    a, b = aimed(pct / 100 - _MARGIN, float("-inf")), aimed(pct / 100 + _MARGIN, float("inf"))
    ends = ends.withColumns({"a": a, "b": b}).drop("sketch")
    spark = df.sparkSession
    brackets = spark.createDataFrame(ends.collect(), ends.schema)  # a row for each day
    y = nan_to_null(F.col(value).cast("double"))
    rows = df.select(F.to_date(ts).alias("day"), y.alias("y")).filter("y IS NOT NULL").select(_until(days, "last"), "y")

    def within(some: DataFrame) -> tuple[DataFrame, DataFrame]:
        held = rows.join(F.broadcast(some), "last")
        counts = held.groupBy("last").agg(F.count_if(F.expr("y < a")).alias("under"), F.count_if(F.expr("y <= b")).alias("upto"))
        return held, some.join(counts, "last")

    held, counted = within(brackets)
    known = counted.collect()
    missed = [r["last"] for r in known if not (r["under"] <= r["low"] and r["high"] < r["upto"])]
    if missed:
        open_ = F.col("last").isin(missed)
        brackets = brackets.withColumns({
            "a": F.when(open_, float("-inf")).otherwise(F.col("a")), "b": F.when(open_, float("inf")).otherwise(F.col("b")),
        })
        held, counted = within(brackets)
        known = counted.collect()
    begins = spark.createDataFrame([(r["last"], r["under"]) for r in known], "last date, under bigint")
    inside = held.filter("y >= a AND y <= b").withColumn("_row", F.row_number().over(Window.partitionBy("last").orderBy("y")))
    placed = inside.join(F.broadcast(begins), "last").withColumn("_rank", F.col("under") + F.col("_row") - 1)
    wanted = placed.filter((F.col("_rank") == F.col("low")) | (F.col("_rank") == F.col("high")))
    share = F.first("rank") - F.first("low")
    value_at = F.min("y") + (F.max("y") - F.min("y")) * share
    return wanted.groupBy("last").agg(F.first("n").alias("n"), value_at.alias("percentile")).withColumnRenamed("last", "day")
