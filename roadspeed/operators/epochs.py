"""The order of an epoch by arithmetic instead of a sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.operators.scale import Moments
from roadspeed.operators.sequences import WindowStore

_ROUNDS = 48


def permuted(position: Column, n: int, epoch: int = 0, seed: int = 42) -> Column:
    """A permutation of the numbers 0 to n - 1, another one for each epoch and seed; no row needs to know another.

    A swap-or-not network: each round pairs every number x with k - x modulo n for a k of its own, and swaps the pair or
    not by a hash bit that both compute alike. So each round is a permutation, whatever n is.
    """
    size = F.lit(n).cast("bigint")
    keys = F.transform(
        F.sequence(F.lit(1), F.lit(_ROUNDS)), lambda turn: F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), turn), size)
    )
    numbered = F.transform(keys, lambda key, turn: F.struct(key.alias("key"), turn.alias("turn")))

    def turn(x: Column, of: Column) -> Column:
        other = F.pmod(of["key"] - x + size, size)
        swap = F.xxhash64(F.lit(seed), F.lit(epoch), of["turn"], F.greatest(x, other)).bitwiseAND(1) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(numbered, position.cast("bigint"), turn)


def numbered(store: WindowStore, moments: Moments | None = None, values: bool = True) -> tuple[DataFrame, int]:
    """The windows that end in the range with their ``position`` from 0 on, and their number.

    Windows are numbered within the scan's splits, and a count for each split says where its numbers begin. Nothing is
    shuffled; the list of counts has a row for each split.
    """
    windows = store.windows(moments) if values else store.targets(moments)
    place = F.monotonically_increasing_id()
    split, row = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    rows = windows.withColumns({"_split": split, "_row": row})
    counts = sorted(tuple(r) for r in rows.groupBy("_split").count().collect())
    begins = [0, *accumulate(n for _, n in counts)]
    offsets = store.chunks.sparkSession.createDataFrame(
        [(split, begin) for (split, _), begin in zip(counts, begins)], "_split bigint, _begin bigint"
    )
    joined = rows.join(F.broadcast(offsets), "_split")
    return joined.withColumn("position", F.col("_begin") + F.col("_row")).drop("_split", "_row", "_begin"), begins[-1]


def epoch_order(
    store: WindowStore, moments: Moments | None = None, epoch: int = 0, seed: int = 42, batch: int = 64, values: bool = True
) -> DataFrame:
    """The windows with their ``place`` in this epoch, from 0 on, and the ``batch`` that it falls into.

    All places are taken once in each epoch. A reader that takes batches by number needs no sort of the windows.
    """
    windows, n = numbered(store, moments, values)
    place = permuted(F.col("position"), max(n, 1), epoch, seed)
    placed = windows.withColumn("place", place).drop("position")
    return placed.withColumn("batch", F.floor(F.col("place") / batch).cast("bigint"))
