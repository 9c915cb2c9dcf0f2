"""Gold rows to forecasting data, model and scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.operators.consensus import FittedSteps, fit_steps
from roadspeed.operators.evaluate import evaluate
from roadspeed.operators.forecast import persistence
from roadspeed.operators.impute import impute
from roadspeed.operators.percentile import target_threshold
from roadspeed.operators.scale import fit_scaler
from roadspeed.operators.sequences import WindowStore, window_store
from roadspeed.operators.split import Split, split_by_time, within
from roadspeed.plans.config import TrainConfig
from roadspeed.session import Scratch


@dataclass(frozen=True)
class TrainingSet:
    """Windows in packed form, and how they were made. Frames of windows are cut from the store when they are read."""

    store: WindowStore
    scaler: DataFrame
    series: DataFrame
    split: Split
    fit_range: tuple[int, int]
    val_range: tuple[int, int]
    threshold: float
    train_samples: int
    val_samples: int
    scratch: Scratch

    def _flagged(self, windows: DataFrame) -> DataFrame:
        sides = {"train": within("end_time", self.fit_range), "validation": within("end_time", self.val_range)}
        return windows.withColumns(sides).filter("train OR validation")

    @property
    def sequences(self) -> DataFrame:
        """Every window with flags ``train`` and ``validation``; both may hold."""
        return self._flagged(self.store.windows())

    @property
    def targets(self) -> DataFrame:
        """The same without the windows' values."""
        return self._flagged(self.store.targets())

    @property
    def train(self) -> DataFrame:
        return self.store.windows(self.fit_range)

    @property
    def validation(self) -> DataFrame:
        return self.store.windows(self.val_range)

    def release(self) -> None:
        """Remove the run's scratch tables; the windows can't be read from then on. The series stays."""
        self.store.release()
        self.scratch.release()


def prepare_series(gold: DataFrame, cfg: TrainConfig = TrainConfig(), scratch: Scratch | None = None) -> DataFrame:
    """Gap-filled series of all channels on the full grid, written once because several passes follow.

    Gaps are filled from the whole period, validation included.
    """
    filled = impute(gold, cfg.measures, step=cfg.step, width=cfg.width)
    return (scratch or Scratch(gold.sparkSession)).materialise(filled, "series")


def training_set(series: DataFrame, cfg: TrainConfig = TrainConfig()) -> TrainingSet:
    """Split, scale and window a prepared series. Raises ValueError when a side is empty."""
    split = split_by_time(series, cfg.val_days, cfg.train_frac)

    # One pass gives the links seen in train and the time range of both sides.
    us, side = F.unix_micros("datetime"), split.in_train
    per_link = series.groupBy("linkid").agg(
        F.min(F.when(side, us)).alias("t0"), F.max(F.when(side, us)).alias("t1"),
        F.min(F.when(~side, us)).alias("v0"), F.max(F.when(~side, us)).alias("v1"),
    ).filter("t0 IS NOT NULL")
    t0, t1, v0, v1 = per_link.agg(F.min("t0"), F.max("t1"), F.min("v0"), F.max("v1")).first()
    if v0 is None:
        raise ValueError("no link of the train side occurs in the validation side")

    # Links outside train have no scaler row and so no window.
    scratch = Scratch(series.sparkSession)
    scaler = fit_scaler(series, cfg.measures, (t0, t1)).join(per_link.select("linkid"), "linkid", "left_semi")
    scaler = scratch.materialise(scaler, "scaler")
    store = window_store(
        series, cfg.seq_len, cfg.horizon, cols=cfg.channels, value=cfg.value, chunk=cfg.span, scaler=scaler
    )
    n_train, n_val = store.counts((t0, t1), (v0, v1))
    if not n_train or not n_val:
        raise ValueError(f"no sequences: train={n_train}, validation={n_val}, seq_len={cfg.seq_len}")
    threshold = target_threshold(store.targets((t0, t1)), cfg.threshold_pct)
    return TrainingSet(store, scaler, series, split, (t0, t1), (v0, v1), threshold, n_train, n_val, scratch)


def fit(data: TrainingSet, cfg: TrainConfig = TrainConfig()) -> FittedSteps:
    """The linear forecast of the best round, and the scores of every round."""
    return fit_steps(
        data.store, data.fit_range, data.val_range, data.threshold, rounds=cfg.rounds, patience=cfg.patience,
        channel=cfg.own_channel,
    )


def sided(data: TrainingSet) -> DataFrame:
    """All windows with ``side``; one that belongs to both sides comes twice."""
    def of(side: str, windows: DataFrame) -> DataFrame:
        return windows.withColumn("side", F.lit(side))

    return of("train", data.train).unionByName(of("validation", data.validation))


def train_and_score(data: TrainingSet, cfg: TrainConfig = TrainConfig()) -> tuple[FittedSteps, DataFrame]:
    """The fit, and n, mae, tp, fp, fn, f1 per model and side."""
    fitted = fit(data, cfg)
    model: Column = F.array(F.lit("l1"), F.lit("persistence"))
    both = persistence(sided(data), cfg.own_channel).withColumnRenamed("pred", "_last")
    guesses = F.arrays_zip(model.alias("model"), F.array("pred", "_last").alias("pred"))
    long = fitted.model.apply(both).select("side", "y", F.inline(guesses))
    return fitted, evaluate(long, data.threshold, "model", "side")
