"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspeed.llm import (
    decontaminate, language_id, line_dedup, mixing, ngram_join, packing, periodic_runs, quality_classifier,
    quality_rules, secret_scan, sharding, suffix_dedup, whitening,
)
from roadspeed.llm.texts import WORD, crc_of_id


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_of_id("doc_id") % 4 == 2
    labels = _table(spark, sf_dir, "labels").filter(~held_out)
    scored = quality_classifier.classify(_table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("repeated"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_of_id("doc_id") % 3 == 1
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, docs.filter(~held_out & F.col("lang").isNotNull()))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind, *_ in secret_scan.KINDS]
    base = F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secret_scan.written(F.col("spans")).alias("spans"), "n_live", "n_copied")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.size("draws")).cast("bigint")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.col("draws.shard").alias("shards"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.array_distinct("hits.item")
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(items).cast("bigint").alias("n_items"),
        items.alias("item_ids"), F.array_min("hits.edits").alias("least_edits"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, components=16, scale=64.0, shift=1_000_000)
    return whitening.by_component(whitening.transform(vectors, model), model)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def _repeated(doc_id: str, text: Column) -> Column:
    """Texts of one id in ten with the words from some place on replaced by repeats of the first of them."""
    hashed = crc_of_id(doc_id)
    rest = F.floor(hashed / 10)
    words = F.when(hashed % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    n = F.size(words)
    at = (rest % n).cast("int")
    period = (1 + F.floor((n - at) / (3 + rest % 8))).cast("int")
    times = F.ceil((n - at) / period).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, at + 1, period), times)), F.lit(1), n - at)
    return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), at), again), " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", _repeated("doc_id", F.col("text")).alias("text")))
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    milli = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        milli.alias("exponent_milli"), F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language_id": op6_language_id,
    "op7_secret_scan": op7_secret_scan,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_packing": op12_packing,
    "op13_periodic_runs": op13_periodic_runs,
}
