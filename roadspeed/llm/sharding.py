"""Sharding by balanced label propagation.

Documents are linked if they share a whole line of ``least_line`` characters; equal texts share everything and form one
unit, cut into chunks where a text is so frequent that it would fill a good part of a shard. Units start in hashed
shards. In each round every linked unit looks for the shard where most of its lines' documents are, and units move there
under quotas: a shard takes in what leaves it in exchange, and what its capacity has room for. At the end the counts are
made exact: what a shard has too many, unlinked documents first, goes to those with too few. The law is ``rows``.

Null text has no bytes. Equal rows get slots of their own. An empty table gives an empty result. Only the named columns
are read. Only counts per pair of shards come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspeed.session import materialise

CHUNK = 100_000  # rows of a unit, and about those of a rank bucket, at most


def _describe(docs: DataFrame, id_col: str, text_col: str, least_line: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(line) >= least_line)
    return docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("g"),
        F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line))).alias("lines"),
    )


def _units(rows: DataFrame, n: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their unit, units with mass and lines)."""
    most = min(max(1, n // (4 * shards)), CHUNK)
    groups = rows.groupBy("g", "crc", "size").agg(F.ceil(F.count("*") / most).alias("chunks"))
    chunk = F.pmod(F.xxhash64("_id"), F.col("chunks"))
    rows = rows.join(groups, ["g", "crc", "size"]).withColumn("u", F.xxhash64("g", "crc", "size", chunk))
    rows = materialise(rows.drop("g", "chunks"), "shard-rows")
    units = rows.groupBy("u").agg(F.count("*").alias("mass"), F.first("lines").alias("lines"))
    return rows.drop("lines"), units


def _acceptance(flows: dict[tuple[int, int], int], loads: dict[int, int], capacity: float) -> dict[tuple[int, int], float]:
    """Share of the wish to move from i to j that the quotas allow."""
    out = {}
    for (i, j), wish in flows.items():
        inflow = sum(m for (_, to), m in flows.items() if to == j)
        room = max(0.0, capacity - loads.get(j, 0))
        out[i, j] = min(1.0, (min(wish, flows.get((j, i), 0)) + room * wish / inflow) / wish)
    return out


def propagate(units: DataFrame, shards: int, rounds: int, slack: float, n: int) -> DataFrame:
    """(u, linked, shard) of every unit after ``rounds`` rounds."""
    units = materialise(units, "units")
    each = units.select("u", "mass", F.explode("lines").alias("line"))
    shared = each.groupBy("line").agg(F.count("*").alias("of")).filter("of > 1").select("line")
    links = materialise(each.join(shared, "line", "left_semi"), "line-links")
    linked = links.select("u").distinct().withColumn("linked", F.lit(True))
    state = units.select("u", "mass", F.pmod("u", F.lit(shards)).cast("int").alias("shard")).join(linked, "u", "left")
    state = materialise(state.select("u", "mass", "shard", F.coalesce("linked", F.col("mass") > 1).alias("linked")), "labels")
    for turn in range(rounds):
        held = links.join(state.select("u", "shard"), "u").groupBy("line", "shard").agg(F.sum("mass").alias("m"))
        best = held.groupBy("line").agg(
            F.max(F.struct("m", F.xxhash64("line", "shard").alias("tie"), "shard")).alias("top"), F.sum("m").alias("all")
        )
        votes = links.join(best, "line").groupBy("u", F.col("top.shard").alias("to")).agg(F.sum(F.col("top.m") / F.col("all")).alias("vote"))
        wish = votes.groupBy("u").agg(F.max(F.struct(F.round("vote", 6).alias("vote"), "to"))["to"].alias("to"))
        asked = materialise(state.join(wish, "u", "left"), "wishes")
        flows = {
            (r["shard"], r["to"]): r["m"]
            for r in asked.filter("to <> shard").groupBy("shard", "to").agg(F.sum("mass").alias("m")).collect()
        }
        if not flows:
            break
        loads = {r["shard"]: r["m"] for r in state.groupBy("shard").agg(F.sum("mass").alias("m")).collect()}
        allowed = F.lit(0.0)
        for (i, j), p in _acceptance(flows, loads, n / shards * (1 + slack)).items():
            allowed = F.when((F.col("shard") == i) & (F.col("to") == j), p).otherwise(allowed)
        draw = F.pmod(F.xxhash64("u", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        state = materialise(asked.withColumn("shard", F.when(draw < allowed, F.col("to")).otherwise(F.col("shard"))).drop("to"), "labels")
    return state.select("u", "linked", "shard")


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, rounds: int = 4,
    slack: float = 0.02, least_line: int = 30,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row; counts of shards are at most one apart."""
    described = materialise(_describe(docs, id_col, text_col, least_line), "described")
    n = described.count()
    rows, units = _units(described, n, shards)
    placed = rows.join(propagate(units, shards, rounds, slack, n), "u")
    buckets = -(-n // (shards * CHUNK)) or 1
    placed = placed.withColumn("bucket", F.pmod("u", F.lit(buckets)) + F.when(F.col("linked"), 0).otherwise(buckets))
    placed = materialise(placed, "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("shard").orderBy("bucket"))
    counts = materialise(counts.withColumn("before", upto - F.col("rows")), "bucket-counts")
    load = {r["shard"]: r["m"] for r in counts.groupBy("shard").agg(F.sum("rows").alias("m")).collect()}

    line = Window.partitionBy("shard", "bucket").orderBy("u", "_id")
    ranked = placed.join(counts.drop("rows"), ["shard", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(line) - 1
    )
    keep = F.lit(None).cast("bigint")
    moved = F.lit(None).cast("bigint")  # number in the pool of rows that leave their shard
    pool, due = 0, []
    for s in range(shards):
        share, has = n // shards + (s < n % shards), load.get(s, 0)
        keep = F.when(F.col("shard") == s, share).otherwise(keep)
        moved = F.when(F.col("shard") == s, F.lit(pool - share)).otherwise(moved)
        pool += max(0, has - share)
        due.append(max(0, share - has))
    number = F.col("rank") + moved
    ranked = ranked.withColumn("pool", F.when(F.col("rank") >= keep, number))
    to, slot, first = F.col("shard"), F.col("rank"), 0
    for s in range(shards):
        here = (F.col("pool") >= first) & (F.col("pool") < first + due[s])
        to = F.when(here, s).otherwise(to)
        slot = F.when(here, F.col("pool") - first + load.get(s, 0)).otherwise(slot)
        first += due[s]
    return ranked.select(
        F.col("_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        to.cast("int").alias("shard"), slot.cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
