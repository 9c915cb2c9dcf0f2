"""Parameters and metrics of training runs as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metrics_table(df: DataFrame, run_id: str, step: str = "step") -> DataFrame:
    """Wide metrics (one row per step) to run_id, step, name, value."""
    names = [c for c in df.columns if c != step]
    wide = df.select(F.col(step).cast("int").alias("step"), *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot("step", names, "name", "value").select(F.lit(run_id).alias("run_id"), "step", "name", "value")


def params_table(spark: SparkSession, run_id: str, params: dict[str, object]) -> DataFrame:
    rows = [(run_id, name, None if value is None else str(value)) for name, value in params.items()]
    return spark.createDataFrame(rows, "run_id string, name string, value string")


def write_run(df: DataFrame, base: str) -> None:
    """Store a run's rows; writing the run again replaces them."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(base)
    )
