"""A day (or a range of days) from archive to scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspeed.operators.consensus import LinearForecast
from roadspeed.plans.config import LakeConfig, TrainConfig
from roadspeed.plans.lake import bronze_to_silver, gold_rows, raw_to_bronze, silver_to_gold
from roadspeed.plans.training import prepare_series, train_and_score, training_set
from roadspeed.session import Scratch
from roadspeed.sinks import WriteReport, land_zip, metrics_table, params_table, write_run
from roadspeed.sources import day_list
from roadspeed.functions import trailing_range
from roadspeed.streaming import file_events, publish_events


@dataclass(frozen=True)
class DayResult:
    landed: DataFrame
    bronze: WriteReport
    silver: WriteReport
    scores: DataFrame
    best_step: int


def land_days(spark: SparkSession, cfg: LakeConfig, start: str, end: str) -> DataFrame:
    """Land what the days' archives hold and the lake does not yet, and announce what landed."""
    landed = land_zip(spark, cfg.archives, cfg.zone("raw"), days=day_list(start, end))
    if cfg.kafka_servers:
        publish_events(file_events(landed, cfg.bucket, "raw"), cfg.kafka_servers, cfg.kafka_topic)
    return landed


def fitted_model(spark: SparkSession, cfg: LakeConfig, run_id: str) -> LinearForecast:
    """The model that a run has kept."""
    return LinearForecast.from_table(spark.read.parquet(cfg.zone("models")).filter(F.col("run_id") == run_id))


def run_range(spark: SparkSession, cfg: LakeConfig, train: TrainConfig, start: str, end: str) -> DayResult:
    """Bring the days start..end to gold, then train on the trailing days up to ``end``."""
    landed = land_days(spark, cfg, start, end)
    bronze = raw_to_bronze(spark, cfg, start, end)
    silver = bronze_to_silver(spark, cfg, start, end)
    silver_to_gold(spark, cfg, start, end)
    first, last = spark.range(1).select(*trailing_range(F.lit(end), train.window_days)).first()
    scratch = Scratch(spark)
    data = training_set(prepare_series(gold_rows(spark, cfg, first, last), train, scratch), train)
    fitted, scores = train_and_score(data, train)
    run_id = f"{first}-{last}"
    write_run(fitted.model.table(spark, run_id), cfg.zone("models"))
    steps = fitted.frame(spark).withColumns({
        "thr_z": F.lit(data.threshold),
        "train_samples": F.lit(data.train_samples),
        "val_samples": F.lit(data.val_samples),
    })
    write_run(metrics_table(steps, run_id), cfg.zone("metrics"))
    write_run(params_table(spark, run_id, {**vars(train), "start_date": first, "end_date": last}), cfg.zone("params"))
    scores = spark.createDataFrame(scores.collect(), scores.schema)  # a row for each model and side
    data.release()
    scratch.release()
    return DayResult(landed, bronze, silver, scores, fitted.best)


def run_day(spark: SparkSession, cfg: LakeConfig, day: str, train: TrainConfig = TrainConfig()) -> DayResult:
    """The daily run."""
    return run_range(spark, cfg, train, day, day)
