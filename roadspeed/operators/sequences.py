"""Future targets and fixed-length input windows.

Both look at neighbouring *rows* of a link, however far apart in time. A link is cut into time
chunks (one day by default) and windows run inside a chunk; the few rows needed from neighbouring
chunks travel in a small side table with one row per link and chunk. So the rows are shuffled
once, by (link, chunk), and no task holds a whole link.

Input has one row per link and time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspeed.functions import floor_div, is_finite, micros, nan_to_null, z_score
from roadspeed.operators.gold import CHANNELS
from roadspeed.operators.grid import timed
from roadspeed.operators.readings import filter_links
from roadspeed.operators.scale import Moments, fit_scaler
from roadspeed.operators.split import to_micros
from roadspeed.session import Scratch

_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _chunked(df: DataFrame, cols: Iterable[str], key: str, ts: str, chunk: str | timedelta) -> DataFrame:
    us = F.unix_micros(ts)
    return (
        timed(df, ts).dropna(subset=[key, ts])
        .withColumns({c: nan_to_null(F.col(c)) for c in cols})
        .withColumns({"_us": us, "_chunk": floor_div(us, micros(chunk))})
    )


def _in_chunk(key: str) -> Window:
    return Window.partitionBy(key, "_chunk").orderBy("_us")


def _ordered(place: str, value: Column) -> Column:
    """Values of a group in the order of ``place``; NULL values are kept."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), value.alias("v"))))
    return F.transform(pairs, lambda pair: pair["v"])


def _next_values(rows: DataFrame, value: str, horizon: int, key: str) -> DataFrame:
    """Per chunk: the first ``horizon`` values that follow it (``_next``)."""
    # Ranks are cut before the shuffle, so only horizon rows per chunk travel.
    first = rows.select(key, "_chunk", "_us", value).withColumn("_rank", F.row_number().over(_in_chunk(key)))
    heads = first.filter(F.col("_rank") <= horizon).groupBy(key, "_chunk").agg(_ordered("_rank", F.col(value)).alias("_head"))
    later = Window.partitionBy(key).orderBy("_chunk").rowsBetween(1, horizon)
    following = heads.select(key, "_chunk", F.flatten(F.collect_list("_head").over(later)).alias("_following"))
    return following.select(key, "_chunk", F.slice("_following", 1, horizon).alias("_next"))


def _with_target(rows: DataFrame, chunks: DataFrame, value: str, horizon: int, key: str, out: str) -> DataFrame:
    order = _in_chunk(key)
    placed = rows.withColumns(
        {
            "_rank": F.row_number().over(order),
            "_size": F.count(F.lit(1)).over(order.rowsBetween(*_WHOLE)),
            "_ahead": F.lead(value, horizon).over(order),
        }
    )
    beyond = (F.col("_rank") + F.lit(horizon) - F.col("_size")).cast("int")
    target = F.when(beyond <= 0, F.col("_ahead")).otherwise(F.try_element_at("_next", F.greatest(beyond, F.lit(1))))
    # A merge join uses the partitioning and order the window has made already.
    return placed.join(chunks.hint("merge"), [key, "_chunk"]).withColumn(out, target)


def add_target(
    df: DataFrame,
    value: str = "self_mean",
    horizon: int = 1,
    key: str = "linkid",
    ts: str = "datetime",
    out: str = "target",
    chunk: str | timedelta = "1 day",
) -> DataFrame:
    """The value ``horizon`` rows later on the same link; NULL at the end of the series."""
    _check(horizon, 1)
    rows = _chunked(df, [value], key, ts, chunk)
    return _with_target(rows, _next_values(rows, value, horizon, key), value, horizon, key, out).select(*df.columns, out)


@dataclass(frozen=True)
class WindowStore:
    """Windows in packed form: a row per link and chunk, and each window is a slice of it.

    ``chunks`` has the link, ``at`` (times of the chunk's rows in microseconds), ``y`` (their targets), ``z`` (standardised
    values of ``before`` earlier rows and of the chunk's own; a list of channels each, or plain numbers for one channel) and
    ``pos``, the rows that end a complete window. So a value is stored about once, however long the windows are.
    """

    chunks: DataFrame
    seq_len: int
    channels: int
    key: str
    scratch: Scratch

    def _ends(self, end_range: Moments | None) -> Column:
        """The rows that end a window, counted from 0, whose time lies in the range."""
        if end_range is None:
            return F.col("pos")
        first, last = (to_micros(moment) for moment in end_range)
        return F.filter("pos", lambda p: F.get("at", p).between(first, last))

    def _exploded(self, end_range: Moments | None, **fields: Callable[[Column], Column]) -> DataFrame:
        # Built before the generator: beside it, whole chunks would be copied for each window.
        windows = F.transform(self._ends(end_range), lambda p: F.struct(*[f(p).alias(n) for n, f in fields.items()]))
        return self.chunks.select(self.key, F.explode(windows).alias("_w")).select(self.key, "_w.*")

    def windows(self, end_range: Moments | None = None) -> DataFrame:
        """linkid, end_time, x, y: one row per window that ends in the range."""
        return self._exploded(
            end_range,
            end_time=lambda p: F.timestamp_micros(F.get("at", p)),
            x=lambda p: F.slice("z", F.col("before") + p + F.lit(2 - self.seq_len), F.lit(self.seq_len)),
            y=lambda p: F.get("y", p),
        )

    def targets(self, end_range: Moments | None = None) -> DataFrame:
        """linkid, end_time, y of the same windows, without making them."""
        return self._exploded(end_range, end_time=lambda p: F.timestamp_micros(F.get("at", p)), y=lambda p: F.get("y", p))

    def counts(self, *ranges: Moments) -> list[int]:
        """The number of windows that end in each range, in one pass over the chunks."""
        sums = [F.coalesce(F.sum(F.size(self._ends(r))), F.lit(0)).alias(f"n{i}") for i, r in enumerate(ranges)]
        return list(self.chunks.agg(*sums).first())

    def release(self) -> None:
        self.scratch.release()


def window_store(
    df: DataFrame,
    seq_len: int = 36,
    horizon: int = 1,
    fit_range: Moments | None = None,
    links: DataFrame | Iterable[str] | None = None,
    cols: Iterable[str] = CHANNELS,
    value: str = "self_mean",
    key: str = "linkid",
    ts: str = "datetime",
    chunk: str | timedelta = "1 day",
    scaler: DataFrame | None = None,
) -> WindowStore:
    """The windows of the series, written once in packed form.

    Values are standardised per link with a scaler fitted on ``fit_range`` (or the one given). Rows
    without a future value are removed first, then windows run over the rows that remain, so a
    window may bridge a gap. Windows with a value that is not a finite number are left out.

    Rows of a chunk are packed into one array (288 rows for a day of 5-minute slots), to which the
    tail of earlier chunks is prepended.
    """
    _check(horizon, seq_len)
    cols = list(cols)
    used = cols if value in cols else [*cols, value]
    frame = filter_links(df, links, key)
    if scaler is None:
        if fit_range is None:
            raise ValueError("give fit_range or scaler")
        scaler = fit_scaler(timed(frame, ts), used, fit_range, key, ts)
    rows = _chunked(frame, used, key, ts, chunk).select(key, ts, "_us", "_chunk", *used)

    # The scaler rides on the chunk table: attaching it does not shuffle the rows by link.
    chunks = _next_values(rows, value, horizon, key).join(scaler, key)
    scores = [z_score(c, f"{c}_mu", f"{c}_sd").cast("float") for c in cols]
    usable = reduce(Column.__and__, [is_finite(z) for z in scores])
    packed = (
        _with_target(rows, chunks, value, horizon, key, "_target")
        .withColumn("y", z_score("_target", f"{value}_mu", f"{value}_sd").cast("float"))
        .filter("y IS NOT NULL")
        .groupBy(key, "_chunk")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("_us").alias("us"), F.col("y").alias("y"), usable.alias("ok"),
                        (scores[0] if len(cols) == 1 else F.array(*scores)).alias("z"),
                    )
                )
            ).alias("_rows")
        )
    )

    # Written for the time of the second step: the tails and the chunks both read it, and nothing above it runs twice.
    spark = df.sparkSession
    passing, scratch = Scratch(spark), Scratch(spark)
    packed = passing.materialise(packed, "packed")

    # A chunk's history is the tails of those earlier chunks that end less than L - 1 rows before it, so the frame holds
    # at most twice that many rows, whatever the chunks hold.
    in_order = Window.partitionBy(key).orderBy("_chunk")
    short = packed.select(
        key, "_chunk", F.size("_rows").cast("long").alias("_n"), _last(F.col("_rows"), seq_len - 1).alias("_tail")
    )
    tails = short.select(
        key, "_chunk", (F.sum("_n").over(in_order) - F.col("_n")).alias("_start_row"), F.lag("_tail").over(in_order).alias("_tail")
    )
    near = Window.partitionBy(key).orderBy("_start_row").rangeBetween(-max(seq_len - 2, 0), 0)
    history = tails.select(key, "_chunk", F.flatten(F.collect_list("_tail").over(near)).alias("_history"))
    previous = history.select(key, "_chunk", _last(F.col("_history"), seq_len - 1).alias("_previous"))

    whole = packed.join(previous, [key, "_chunk"]).withColumn("_all", F.concat("_previous", "_rows")).select(
        key, F.transform("_rows", lambda r: r["us"]).alias("at"), F.transform("_rows", lambda r: r["y"]).alias("y"),
        F.transform("_all", lambda r: r["z"]).alias("z"), F.transform("_all", lambda r: r["ok"]).alias("_ok"),
        F.size("_previous").alias("before"),
    )

    def ends_window(p: Column) -> Column:
        start = F.col("before") + p + F.lit(2 - seq_len)
        inside = F.slice("_ok", F.greatest(start, F.lit(1)), F.lit(seq_len))
        return (start >= 1) & is_finite(F.get("y", p)) & ~F.array_contains(inside, False)

    ends = F.filter(F.sequence(F.lit(0), F.size("at") - 1), ends_window)
    stored = scratch.materialise(whole.select(key, "at", "y", "z", "before", ends.alias("pos")), "windows")
    passing.release()
    return WindowStore(stored, seq_len, len(cols), key, scratch)


def build_sequences(
    df: DataFrame,
    seq_len: int = 36,
    horizon: int = 1,
    fit_range: Moments | None = None,
    end_range: Moments | None = None,
    links: DataFrame | Iterable[str] | None = None,
    cols: Iterable[str] = CHANNELS,
    value: str = "self_mean",
    key: str = "linkid",
    ts: str = "datetime",
    chunk: str | timedelta = "1 day",
    scaler: DataFrame | None = None,
) -> DataFrame:
    """linkid, end_time, x, y (float): one row per window of ``window_store``.

    ``x`` is [seq_len][channels] float; with a single column it is a flat [seq_len]. Only the window's last time is tested
    against ``end_range``. The windows are cut from the store whenever the frame is read.
    """
    store = window_store(df, seq_len, horizon, fit_range, links, cols, value, key, ts, chunk, scaler)
    return store.windows(end_range)


def _last(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - (n - 1), F.lit(1)), n)


def _check(horizon: int, seq_len: int) -> None:
    if horizon < 1 or seq_len < 1:
        raise ValueError("horizon and seq_len start at 1")


def expand_channels(sequences: DataFrame, channels: int = len(CHANNELS)) -> DataFrame:
    """Flat windows of one channel to windows of equal channels.

    The channels are copies today, so pipelines store one and widen here, after all shuffles.
    """
    return sequences.withColumn("x", F.transform("x", lambda z: F.array_repeat(z, channels)))


def channel_values(sequences: DataFrame, channel: int) -> Column:
    """The values of one channel along a window, flat or not."""
    nested = isinstance(sequences.schema["x"].dataType.elementType, T.ArrayType)
    return F.transform("x", lambda step: step[channel]) if nested else F.col("x")


def shuffle_samples(sequences: DataFrame, seed: int = 42, key: str = "linkid", end: str = "end_time") -> DataFrame:
    """A random but repeatable order; a distributed sort on a hash."""
    return sequences.orderBy(F.xxhash64(F.lit(seed), key, end), key, end)
