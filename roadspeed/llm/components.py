"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is one aggregation and one join; a step's links are written to the shared scratch folder, so nothing is
recomputed and no component is gathered anywhere. The number of steps grows with the logarithm of a component's width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of the columns ``a`` and ``b`` that is not its own."""
    now = materialise(_small_star(links.select("a", "b")), "links")
    state = _state(now)
    while state[0]:
        now = materialise(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
