"""Training-data pipeline over ``documents``: rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``. Missing, empty and repeated documents follow the operators:
text without words fails the rules, equal rows of one id become one in the second stage, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspeed.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from roadspeed.session import materialise

ID = "doc_id"


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select(ID), ID, "left_semi").select(*docs.columns)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the row rules or their host's verdict reject."""
    return _only(docs, quality_rules.quality_rules(docs).filter("kept"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8, the smallest id stays."""
    groups = ngram_join.ngram_components(docs, width=5, percent=80)
    return _only(docs, groups.filter(F.col("component_id") == F.col(ID))).dropDuplicates([ID])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _only(docs, decontaminate.find_leaks(docs, benchmark).filter(F.size("hits") == 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it."""
    return mixing.drawn(docs, mixing.mix(docs)).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", keep_by_rules),
    ("ngram_join", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# The hashed mix and the label propagation have no SQL counterpart; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
