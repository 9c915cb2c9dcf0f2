"""Scores of predictions and of training steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.functions import finite_or_zero, is_finite


def evaluate(predictions: DataFrame, threshold: float, *by: str, y: str = "y", pred: str = "pred") -> DataFrame:
    """n, mae, tp, fp, fn, f1 of ``pred`` against ``y``, in one pass.

    A row is positive (congested) when its value is at or below the threshold. Values that are no
    finite numbers count as 0. F1 is 0 when it is undefined.
    """
    truth, guess = finite_or_zero(F.col(y).cast("double")), finite_or_zero(F.col(pred).cast("double"))
    hit, said = F.col("_y") <= threshold, F.col("_p") <= threshold
    counts = (
        predictions.select(*by, truth.alias("_y"), guess.alias("_p"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.avg(finite_or_zero(F.abs(F.col("_p") - F.col("_y")))), F.lit(0.0)).alias("mae"),
            F.count_if(said & hit).alias("tp"),
            F.count_if(said & ~hit).alias("fp"),
            F.count_if(~said & hit).alias("fn"),
        )
    )
    weight = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return counts.withColumn("f1", F.when(weight > 0, 2 * F.col("tp") / weight).otherwise(0.0))


def best_step(metrics: DataFrame, name: str = "val_mae") -> DataFrame:
    """Per run the step with the lowest finite value of a metric; the first one on ties."""
    usable = metrics.filter((F.col("name") == name) & is_finite("value"))
    best = F.min(F.struct("value", "step"))
    return usable.groupBy("run_id").agg(best.alias("best")).select("run_id", "best.step", "best.value")
