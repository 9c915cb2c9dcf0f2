"""Exact percentiles without sorting or collecting the column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that one task may sort, and the accuracy of the sketch used above that.
_SMALL = 1_000_000
_ACCURACY = 10_000


def exact_percentile(df: DataFrame, column: str, pct: float, small: int = _SMALL, accuracy: int = _ACCURACY) -> float:
    """The ``pct``-th percentile (0..100) with linear interpolation; NULL and NaN are skipped.

    Spark's exact ``percentile`` keeps every distinct value in one buffer. Here a quantile sketch
    of fixed size brackets the wanted ranks, exact counts confirm the bracket, and the search
    repeats inside it (each round keeps about 4/accuracy of the rows) until it is small.
    """
    if not 0 <= pct <= 100:
        raise ValueError(f"percentile out of range: {pct}")
    y = F.col("y")
    rows = df.select(F.col(column).cast("double").alias("y")).filter(y.isNotNull() & ~F.isnan(y))
    count, low, high = rows.agg(F.count("y"), F.min("y"), F.max("y")).first()
    if not count:
        raise ValueError(f"no values in {column}")
    rank = pct / 100 * (count - 1)
    ranks = math.floor(rank), math.ceil(rank)
    below = 0
    while True:
        inside = rows.filter(y.between(low, high))
        # Two ranks with nothing between their values need no further search.
        if low == high or count <= max(small, 2):
            break
        # Aim a little outside the wanted ranks, by more than the sketch's error.
        margin = 2 / accuracy
        aims = [max((ranks[0] - below) / count - margin, 0.0), min((ranks[1] - below + 1) / count + margin, 1.0)]
        a, b = inside.agg(F.percentile_approx("y", aims, accuracy)).first()[0]
        under, upto = inside.agg(F.count_if(y < a), F.count_if(y <= b)).first()
        if not (below + under <= ranks[0] and ranks[1] < below + upto) or upto - under == count:
            # The sketch missed or cannot narrow further: go on with one side of its median.
            a, b, under, upto = _one_side(inside, high, ranks[0] - below, ranks[1] - below, accuracy)
            if under is None:
                return float(a + (b - a) * (rank - ranks[0]))
        low, high, below, count = a, b, below + under, upto - under
    if low == high:
        return float(low)
    first = ranks[0] - below
    got = [r[0] for r in inside.orderBy("y").offset(first).limit(ranks[1] - ranks[0] + 1).collect()]
    return float(got[0] + (got[-1] - got[0]) * (rank - ranks[0]))


def _one_side(inside: DataFrame, high: float, first: int, last: int, accuracy: int) -> tuple[float, float, int | None, int | None]:
    """The part of ``inside`` that holds the ranks first..last, cut after a median value.

    Returns its lowest and highest value and the counts below its start and up to its end, or just
    the two values when each holds one of the ranks. The cut lies below ``high``, so either part is
    smaller than the whole.
    """
    y = F.col("y")
    pivot = inside.agg(F.percentile_approx("y", 0.5, accuracy)).first()[0]
    goes_left = y < high if pivot == high else y <= pivot
    low, left, right, upto, total = inside.agg(
        F.min("y"), F.max(F.when(goes_left, y)), F.min(F.when(~goes_left, y)), F.count_if(goes_left), F.count("y")
    ).first()
    if last < upto:
        return low, left, 0, upto
    if first >= upto:
        return right, high, upto, total
    # The two ranks lie on both sides of the cut, so the values next to it are the answer.
    return left, right, None, None


def target_threshold(sequences: DataFrame, pct: float = 25.0, column: str = "y") -> float:
    """Congestion threshold: targets at or below it count as congested."""
    return exact_percentile(sequences, column, pct)
