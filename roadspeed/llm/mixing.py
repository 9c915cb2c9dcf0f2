"""Mixing sources to target weights, in DataFrame functions only.

Targets share all words by source weight, none above ``most`` times what its source has. A source's documents fall into
blocks by a hash. Each source takes whole rounds of all its blocks, then blocks in a hashed order up to its target; in
the block where the target falls, documents are taken one by one, and last the one that fits the rest best.

The block draws go through a splitting tree: the draws of a node are cut in two equal halves in hash order, which deals
each source's exact quota to the halves as a multivariate hypergeometric draw, and so on down to the shards. Shards hold
disjoint draws; within a shard the documents get a hashed order. Everything follows from the seed, so reruns agree.

Null and empty texts have size 0 and are taken as often as their block. A null source is a source, the last. A repeated
id gets the same decisions for each of its rows. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspeed.llm.texts import WORD
from roadspeed.session import materialise


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(_source, n, source_size, target): one row per source.

    Sources fill up in the order of their limit for a unit of weight; the first one that stays below its limit gives
    the words per weight for itself and all after it.
    """
    sources = sizes.groupBy("_source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    sources = sources.withColumn("weight", F.element_at(listed, F.pmod(number, F.lit(len(weights))) + 1))
    limit = (F.lit(float(most)) * F.col("source_size")).alias("limit")
    sources = sources.select("*", limit)
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("_source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    full, spent = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("limit", "weight"))
    totals = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("all_weight"))  # one row
    stepped = sources.withColumn("full", full).withColumn("spent", spent).join(totals)
    share = (F.col("words") - F.col("full")) / (F.col("all_weight") - F.col("spent"))
    stepped = stepped.withColumn("share", share)
    fits = F.col("share") * F.col("weight") <= F.col("limit")
    level = stepped.filter(fits).agg(F.min(F.struct(F.col("spent"), F.col("share")))["share"].alias("level"))  # one row
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return sources.join(level).select("_source", "n", "source_size", target.alias("target"))


def _dealt(*cols: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["_source"].eqNullSafe(b["_source"])


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3, shards: int = 8, block_docs: int = 1024, seed: int = 7,
) -> DataFrame:
    """(id, size, source_size, target, draws) per row; ``draws`` is an array of (round, shard), one for each time the
    document is taken. ``shards`` is a power of two. See ``drawn`` for the mixed rows."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    sizes = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"), size.alias("size"))
    sizes = materialise(sizes, "sizes")
    targets = materialise(source_targets(sizes, weights, most), "targets")
    quota = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.when(F.col("source_size") > 0, quota - rounds * F.col("source_size")).otherwise(0)
    plan = targets.withColumn("rounds", rounds).withColumn("rest", rest)
    n_blocks = F.greatest(F.ceil(F.col("n") / block_docs), F.least(F.col("n"), F.lit(8 * shards)))
    plan = plan.withColumn("n_blocks", n_blocks)
    block = F.pmod(_dealt("_id", seed=seed), F.col("n_blocks"))
    placed = sizes.join(plan, _same_source(sizes, plan)).select(
        "_id", sizes["_source"], "size", "source_size", "target", "rounds", "rest", block.alias("block")
    )
    placed = materialise(placed, "placed")

    blocks = placed.groupBy("_source", "block").agg(
        F.sum("size").alias("words"), F.first("rounds").alias("rounds"), F.first("rest").alias("rest")
    )
    order = Window.partitionBy("_source").orderBy(_dealt("_source", "block", seed=seed + 1), "block")
    blocks = blocks.withColumn("upto", F.sum("words").over(order))
    state = F.when(F.col("upto") <= F.col("rest"), "whole").when(F.col("upto") - F.col("words") < F.col("rest"), "part").otherwise("none")
    blocks = materialise(blocks.withColumn("state", state), "blocks")

    cut = blocks.filter("state = 'part'").select("_source", "block", (F.col("upto") - F.col("words")).alias("already"))
    inside = placed.join(cut, _same_source(placed, cut) & (placed["block"] == cut["block"])).select(
        "_id", placed["_source"].alias("_source"), placed["block"].alias("block"), "size", "rest", "already"
    )
    line = Window.partitionBy("_source").orderBy(_dealt("_id", seed=seed + 2), "_id")
    inside = materialise(inside.withColumn("upto", F.col("already") + F.sum("size").over(line)), "cut")
    taken = inside.filter("upto <= rest")
    reached = inside.groupBy("_source").agg(
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.max("already")).alias("reached"),
        F.first("rest").alias("rest"),
    ).select("_source", (F.col("rest") - F.col("reached")).alias("gap"))
    left = blocks.filter("state = 'none'").select("_source", "block")
    left = placed.join(left, _same_source(placed, left) & (placed["block"] == left["block"])).select(
        "_id", placed["_source"].alias("_source"), placed["block"].alias("block"), "size"
    )
    open_ = left.union(inside.filter("upto > rest").select("_id", "_source", "block", "size"))
    open_ = open_.join(reached, _same_source(open_, reached)).select(
        "_id", open_["_source"].alias("_source"), "block", F.abs(F.col("size") - F.col("gap")).alias("miss"), "gap"
    )
    best = open_.filter("miss < gap").groupBy("_source").agg(F.min(F.struct("miss", "_id", "block")).alias("best"))
    best = materialise(best.select("_source", "best._id", "best.block"), "best")
    chosen = taken.select("_id").union(best.select("_id")).distinct().withColumn("chosen", F.lit(True))
    fitted = best.select(F.col("_source").alias("s"), F.col("block").alias("b"))
    blocks = blocks.join(
        fitted, F.col("_source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left"
    ).withColumn("state", F.when(F.col("b").isNotNull(), "part").otherwise(F.col("state"))).drop("s", "b")

    times = F.col("rounds") + F.when(F.col("state") == "none", 0).otherwise(1)
    units = blocks.filter(times > 0).select("_source", "block", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("round"))
    units = units.withColumn("shard", F.lit(0))
    for level in range(int(math.log2(shards))):
        node = Window.partitionBy("shard")
        place = F.row_number().over(node.orderBy(_dealt("shard", "_source", "block", "round", seed=seed + 3 + level), "_source", "block", "round"))
        right = (2 * place > F.count("*").over(node)).cast("int")
        units = units.select("_source", "block", "round", (2 * F.col("shard") + right).alias("shard"))
    dealt = units.groupBy("_source", "block").agg(F.sort_array(F.collect_list(F.struct("round", "shard"))).alias("dealt"))
    dealt = blocks.select("_source", "block", "state").join(
        dealt.withColumnRenamed("_source", "s").withColumnRenamed("block", "b"),
        F.col("_source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left",
    ).select("_source", "block", "state", "dealt")
    dealt = materialise(dealt, "dealt")
    out = placed.join(dealt, _same_source(placed, dealt) & (placed["block"] == dealt["block"])).join(chosen, "_id", "left")
    none = F.array().cast("array<struct<round:int,shard:int>>")
    wanted = F.filter("dealt", lambda d: (d["round"] <= F.col("rounds")) | (F.col("state") == "whole") | F.coalesce("chosen", F.lit(False)))
    return out.select(
        F.col("_id").alias(id_col), "size", "source_size", "target", F.coalesce(wanted, none).alias("draws")
    )


def drawn(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as it was drawn, with ``mix_shard`` and ``mix_order`` within the shard."""
    each = mixed.select(F.col(id_col).alias("_drawn_id"), F.explode("draws").alias("draw")).distinct()
    order = _dealt("_drawn_id", "draw.round", seed=seed + 99).alias("mix_order")
    each = each.select("_drawn_id", F.col("draw.shard").alias("mix_shard"), order)
    return docs.join(each, docs[id_col] == each["_drawn_id"]).drop("_drawn_id")
