"""Next-slot forecasts from windows: a linear model and two baselines."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.functions import micros, minute_of_day, nan_to_null, z_score
from roadspeed.operators.gold import CHANNELS
from roadspeed.operators.scale import Moments
from roadspeed.operators.sequences import channel_values
from roadspeed.operators.split import within

SELF = CHANNELS.index("self_mean")


def _features(sequences: DataFrame, channels: Iterable[int]) -> DataFrame:
    values = F.concat(*[channel_values(sequences, i) for i in channels])
    return sequences.withColumn("features", array_to_vector(values.cast("array<double>")))


def fit_forecast(
    train: DataFrame,
    channels: Iterable[int] = (SELF,),
    max_iter: int = 20,
    reg: float = 1e-3,
    epsilon: float = 1.35,
) -> LinearRegressionModel:
    """Huber regression of y on the window (absolute loss beyond ``epsilon``).

    Channels that are copies add nothing to a linear model, so one is used by default. Fitting is
    distributed: each iteration is one aggregation over the rows. ``channels`` matter for windows with
    several channels only.
    """
    model = LinearRegression(
        featuresCol="features", labelCol="label", predictionCol="pred", loss="huber",
        maxIter=max_iter, regParam=reg, epsilon=epsilon,
    )
    return model.fit(_features(train, channels).select("features", F.col("y").cast("double").alias("label")))


def forecast(model: LinearRegressionModel, sequences: DataFrame, channels: Iterable[int] = (SELF,)) -> DataFrame:
    """The sequences with ``pred``."""
    return model.transform(_features(sequences, channels)).drop("features")


def persistence(sequences: DataFrame, channel: int = SELF) -> DataFrame:
    """Prediction: the last value of the window."""
    return sequences.withColumn("pred", F.element_at(channel_values(sequences, channel), -1).cast("double"))


def seasonal_naive(
    sequences: DataFrame,
    series: DataFrame,
    scaler: DataFrame,
    fit_range: Moments,
    horizon: int = 1,
    step: str | timedelta = "5 minutes",
    value: str = "self_mean",
    key: str = "linkid",
    ts: str = "datetime",
) -> DataFrame:
    """Prediction: the link's mean at the target's weekday and time of day within ``fit_range``."""
    season = [F.weekday(ts).alias("_weekday"), minute_of_day(ts).alias("_minute")]
    means = (
        series.filter(within(ts, fit_range))
        .groupBy(key, *season)
        .agg(F.avg(nan_to_null(F.col(value))).alias("_mean"))
        .join(scaler, key)
        .select(key, "_weekday", "_minute", z_score("_mean", f"{value}_mu", f"{value}_sd").alias("pred"))
    )
    target = F.timestamp_micros(F.unix_micros("end_time") + horizon * micros(step))
    keyed = sequences.withColumns({"_weekday": F.weekday(target), "_minute": minute_of_day(target)})
    return keyed.join(means, [key, "_weekday", "_minute"], "left").drop("_weekday", "_minute")
