"""A linear forecast with absolute loss, fitted in rounds and scored after each of them.

A round is two jobs over the window store. In the first every task cuts its windows into shards of bounded size and solves
each shard's own problem near the current weights; Spark averages the solutions by their number of windows. In the second
all windows of both sides are scored with the average, which also gives the gradient for the next round. The shards'
problems carry the difference between their gradient and that of all windows, so the optimum of all windows is a fixed
point of the rounds, however differently the shards are made up. An average that raises the training objective is not taken;
the shards are then held closer to the current weights.

Only weights, gradients and sums leave the tasks: some numbers for each weight. A task holds the windows of one shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.operators.scale import Moments
from roadspeed.operators.sequences import WindowStore
from roadspeed.operators.split import to_micros

_PART = "name string, at int, value double"
Windows = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class LinearForecast:
    """``weights`` for the window's values, oldest first and channels side by side, then the constant."""

    weights: np.ndarray
    seq_len: int
    channels: int

    def apply(self, sequences: DataFrame) -> DataFrame:
        """The sequences with ``pred``."""
        flat = F.col("x") if self.channels == 1 else F.flatten("x")
        factors = F.array(*(F.lit(float(w)) for w in self.weights[:-1]))
        terms = F.zip_with(flat, factors, lambda z, w: z.cast("double") * w)
        return sequences.withColumn("pred", F.aggregate(terms, F.lit(float(self.weights[-1])), lambda a, b: a + b))

    def table(self, spark, run_id: str) -> DataFrame:
        """run_id, lag (0 for the last value), channel, weight; the constant has neither lag nor channel."""
        rows = [
            (run_id, self.seq_len - 1 - i // self.channels, i % self.channels, float(w))
            for i, w in enumerate(self.weights[:-1])
        ]
        return spark.createDataFrame(
            [*rows, (run_id, None, None, float(self.weights[-1]))], "run_id string, lag int, channel int, weight double"
        )

    @staticmethod
    def from_table(table: DataFrame) -> "LinearForecast":
        rows = table.collect()  # a row for each weight
        lags, channels = (max(r[c] for r in rows if r["lag"] is not None) + 1 for c in ("lag", "channel"))
        weights = np.zeros(lags * channels + 1)
        for r in rows:
            weights[-1 if r["lag"] is None else (lags - 1 - r["lag"]) * channels + r["channel"]] = r["weight"]
        return LinearForecast(weights, lags, channels)


@dataclass
class FittedSteps:
    """The weights of the step with the lowest validation error, and what each step scored."""

    model: LinearForecast
    steps: list[dict[str, float]] = field(default_factory=list)
    best: int = 0

    def frame(self, spark) -> DataFrame:
        names = [n for n in self.steps[0] if n != "step"]
        schema = "step int, " + ", ".join(f"{n} double" for n in names)
        return spark.createDataFrame([(int(s["step"]), *(float(s[n]) for n in names)) for s in self.steps], schema)


def _windows(batches: Iterator[pa.RecordBatch], seq_len: int, channels: int) -> Windows:
    """(inputs with a final 1, targets, end times) of each chunk."""
    for batch in batches:
        at, y, z, before, pos = (batch.column(i) for i in range(5))
        flat = z.values.values if channels > 1 else z.values
        values = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, channels)
        times, targets, ends = (c.values.to_numpy(zero_copy_only=False) for c in (at, y, pos))
        cuts = [c.offsets.to_numpy() for c in (at, y, z, pos)]
        for i, earlier in enumerate(before.to_pylist()):
            own_at, own_y, own_z, own = (v[c[i] : c[i + 1]] for v, c in zip((times, targets, values, ends), cuts))
            if not len(own):
                continue
            every = np.lib.stride_tricks.sliding_window_view(own_z, seq_len, axis=0).transpose(0, 2, 1)
            x = np.ones((len(own), seq_len * channels + 1))
            x[:, :-1] = every[own + earlier - seq_len + 1].reshape(len(own), -1)
            yield x, own_y[own].astype(float), own_at[own]


def _shards(windows: Windows, moments: tuple[int, int], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of the range, about ``size`` at a time."""
    held, rows = [], 0
    for x, y, at in windows:
        inside = (at >= moments[0]) & (at <= moments[1])
        held.append((x[inside], y[inside]))
        rows += int(inside.sum())
        if rows >= size:
            yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            held, rows = [], 0
    if rows:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def _rows(sums: dict[str, np.ndarray | float]) -> Iterator[pa.RecordBatch]:
    named = [(name, i, v) for name, value in sums.items() for i, v in enumerate(np.atleast_1d(value).tolist())]
    if named:
        names, at, values = zip(*named)
        columns = [pa.array(names), pa.array(at, pa.int32()), pa.array(values, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["name", "at", "value"])


def _summed(store: WindowStore, run: Callable[[Windows], dict]) -> dict[str, np.ndarray]:
    """Sums over all tasks, by name."""
    seq_len, channels = store.seq_len, store.channels

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rows(run(_windows(batches, seq_len, channels)))

    parts = store.chunks.select("at", "y", "z", "before", "pos").mapInArrow(task, _PART)
    out: dict[str, dict[int, float]] = {}
    for name, at, value in parts.groupBy("name", "at").agg(F.sum("value")).collect():  # some numbers for each weight
        out.setdefault(name, {})[at] = value
    return {name: np.array([values[i] for i in range(len(values))]) for name, values in out.items()}


def _slopes(rest: np.ndarray, corner: float) -> np.ndarray:
    """The derivative of the loss: absolute, rounded within ``corner`` of zero."""
    return rest / np.maximum(np.abs(rest), corner)


def _loss(rest: np.ndarray, corner: float) -> np.ndarray:
    size = np.abs(rest)
    return np.where(size > corner, size, rest * rest / (2 * corner) + corner / 2)


def _score(store: WindowStore, weights: np.ndarray, sides: dict[str, tuple[int, int]], threshold: float, corner: float) -> dict:
    def run(windows: Windows) -> dict:
        sums: dict[str, np.ndarray | float] = {}

        def add(name: str, value: np.ndarray | float) -> None:
            sums[name] = sums.get(name, 0.0) + value

        for x, y, at in windows:
            pred = x @ weights
            rest = pred - y
            for side, (first, last) in sides.items():
                own = (at >= first) & (at <= last)
                if not own.any():
                    continue
                hit, said = y[own] <= threshold, pred[own] <= threshold
                add(f"{side}_n", own.sum())
                add(f"{side}_error", np.abs(rest[own]).sum())
                add(f"{side}_tp", (hit & said).sum())
                add(f"{side}_wrong", (hit != said).sum())
                if side == "train":
                    add("objective", _loss(rest[own], corner).sum())
                    add("gradient", _slopes(rest[own], corner) @ x[own])
        return sums

    return _summed(store, run)


def _solved(
    store: WindowStore, weights: np.ndarray, gradient: np.ndarray, pull: float, reg: float, corner: float,
    moments: tuple[int, int], size: int, turns: int = 6,
) -> np.ndarray:
    """The mean of the shards' solutions."""
    penalty = np.full(len(weights), reg)
    penalty[-1] = 0.0

    def run(windows: Windows) -> dict:
        total, count = np.zeros(len(weights)), 0
        for x, y in _shards(windows, moments, size):
            own = _slopes(x @ weights - y, corner) @ x / len(y) + penalty * weights
            now = weights
            for _ in range(turns):  # reweighted least squares
                share = 1 / np.maximum(np.abs(x @ now - y), corner) / len(y)
                left = (x * share[:, None]).T @ x + np.diag(penalty + pull)
                now = np.linalg.solve(left, (share * y) @ x + own - gradient + pull * weights)
            total += len(y) * now
            count += len(y)
        return {"solution": total, "n": count} if count else {}

    sums = _summed(store, run)
    return sums["solution"] / sums["n"][0]


def fit_steps(
    store: WindowStore,
    fit_range: Moments,
    val_range: Moments,
    threshold: float,
    rounds: int = 12,
    patience: int | None = 4,
    reg: float = 1e-4,
    pull: float = 1e-2,
    corner: float = 0.02,
    shard: int = 1 << 15,
    channel: int = 0,
) -> FittedSteps:
    """Fit on the windows that end in ``fit_range`` and score both sides after each round.

    Step 0 is the last value of ``channel``. A step has train_mae, val_mae, train_f1, val_f1 and ``best``, the lowest
    validation error so far. The model is that of the step with the lowest one. The fit ends after ``rounds`` or when
    ``patience`` rounds in a row have not lowered it by a thousandth.
    """
    sides = {"train": tuple(map(to_micros, fit_range)), "val": tuple(map(to_micros, val_range))}
    weights = np.zeros(store.seq_len * store.channels + 1)
    weights[channel - 1 - store.channels] = 1.0
    penalty = np.full(len(weights), reg)
    penalty[-1] = 0.0
    shape = (store.seq_len, store.channels)
    fitted, kept, waited, step = FittedSteps(LinearForecast(weights, *shape)), None, 0, 0
    while True:
        sums = _score(store, weights, sides, threshold, corner)
        if "train_n" not in sums:
            raise ValueError("no windows to fit")
        n = sums["train_n"][0]
        objective = sums["objective"][0] / n + 0.5 * float(penalty @ (weights * weights))
        scores = {"step": step}
        for side in sides:
            tp, wrong, rows = (sums.get(f"{side}_{x}", np.zeros(1))[0] for x in ("tp", "wrong", "n"))
            scores[f"{side}_mae"] = sums[f"{side}_error"][0] / rows if rows else float("nan")
            scores[f"{side}_f1"] = 2 * tp / (2 * tp + wrong) if tp + wrong else 0.0
        lowest = min([s["val_mae"] for s in fitted.steps], default=float("inf"))
        error = scores["val_mae"]
        waited = 0 if error < lowest * (1 - 1e-3) else waited + 1
        if error < lowest or not fitted.steps:
            fitted.model, fitted.best = LinearForecast(weights, *shape), step
        scores["best"] = min(lowest, error)
        fitted.steps.append(scores)
        if kept is None or objective <= kept[0]:
            kept = (objective, weights, sums["gradient"] / n + penalty * weights)
        else:
            pull *= 10
        if step == rounds or (patience is not None and waited > patience):
            return fitted
        weights = _solved(store, kept[1], kept[2], pull, reg, corner, sides["train"], shard)
        step += 1
