"""The fit in rounds against a fit of all windows at once, and the packed windows it reads."""

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from series_helpers import START, slots

from check import ROOT
from roadspeed.operators import LinearForecast, best_step, evaluate, fit_steps, persistence, window_store
from roadspeed.operators.split import to_micros
from roadspeed.plans import TrainConfig, prepare_series, train_and_score, training_set
from roadspeed.plans.training import fit
from roadspeed.sinks import metrics_table
from workload.adapters import gold_by_type
from workload.queries import DAYS_CONFIG, forecast_eval

ALL = (START - timedelta(days=1), START + timedelta(days=100))


def waves(n, seed, channels=1):
    rng = np.random.default_rng(seed)
    base = np.sin(np.arange(n) / 7)[:, None] * rng.uniform(1, 3, channels) + rng.standard_normal((n, channels))
    return np.round(50 + 5 * base + 20 * (rng.random((n, 1)) < 0.03), 2)


@pytest.fixture
def two_channels(spark):
    rows = [
        (link, at.isoformat(sep=" "), float(a), None if i % 97 == 5 else float(b))
        for link, seed in (("a", 1), ("b", 2))
        for i, (at, (a, b)) in enumerate(zip(slots(900), waves(900, seed, 2)))
    ]
    df = spark.createDataFrame(rows, "linkid string, at string, speed double, flow double")
    return df.select("linkid", F.col("at").cast("timestamp").alias("datetime"), "speed", "flow")


def store_of(df, **how):
    how = {"seq_len": 6, "fit_range": ALL, "cols": ["speed", "flow"], "value": "speed", **how}
    return window_store(df, **how)


def arrays(store, moments=None):
    rows = store.windows(moments).orderBy("linkid", "end_time").collect()
    return np.array([np.ravel(r.x) for r in rows]), np.array([r.y for r in rows])


def at_once(x, y, reg, corner):
    """The same loss, minimised over all windows in one place."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], reg)
    penalty[-1] = 0
    w = np.zeros(x.shape[1])
    for _ in range(500):
        share = 1 / np.maximum(np.abs(x @ w - y), corner) / len(y)
        w = np.linalg.solve((x * share[:, None]).T @ x + np.diag(penalty), (share * y) @ x)
    return w


@pytest.mark.parametrize("shard", [40, 300, 1 << 15])
def test_rounds_reach_the_fit_of_all_windows(two_channels, shard):
    store = store_of(two_channels)
    cut = START + timedelta(minutes=5 * 700)
    fitted = fit_steps(store, (START, cut), (cut, ALL[1]), 0.0, rounds=25, patience=None, shard=shard, channel=0)
    x, y = arrays(store, (START, cut))
    wanted = at_once(x, y, 1e-4, 0.02)
    last = fitted.steps[-1]
    assert last["train_mae"] <= np.abs(x @ wanted[:-1] + wanted[-1] - y).mean() * 1.002
    assert len(fitted.steps) == 26 and fitted.steps[0]["train_mae"] == pytest.approx(np.abs(x[:, -2] - y).mean())
    best = [s["best"] for s in fitted.steps]
    assert best == sorted(best, reverse=True) and best[-1] == min(s["val_mae"] for s in fitted.steps)


def test_scores_of_a_step_are_those_of_its_predictions(spark, two_channels):
    store = store_of(two_channels)
    cut = START + timedelta(minutes=5 * 700)
    sides = {"train": (START, cut), "val": (cut, ALL[1])}
    fitted = fit_steps(store, *sides.values(), 0.3, rounds=6, patience=None, shard=200)
    step = fitted.steps[fitted.best]
    for side, moments in sides.items():
        scored = evaluate(fitted.model.apply(store.windows(moments)), 0.3).first()
        assert scored.mae == pytest.approx(step[f"{side}_mae"], rel=1e-9) and scored.f1 == pytest.approx(step[f"{side}_f1"])
    metrics = metrics_table(fitted.frame(spark), "r")
    chosen = best_step(metrics).first()
    assert metrics.filter("name = 'val_mae'").count() > 5
    assert chosen.step == fitted.best and chosen.value == step["val_mae"]
    back = LinearForecast.from_table(fitted.model.table(spark, "r"))
    assert (back.weights == fitted.model.weights).all() and (back.seq_len, back.channels) == (6, 2)


def test_fit_stops_when_nothing_gets_better(two_channels):
    store = store_of(two_channels)
    cut = START + timedelta(minutes=5 * 700)
    fitted = fit_steps(store, (START, cut), (cut, ALL[1]), 0.0, rounds=60, patience=2)
    assert 3 < len(fitted.steps) < 40 and fitted.best < len(fitted.steps)
    with pytest.raises(ValueError):
        fit_steps(store, (ALL[1], ALL[1]), (cut, ALL[1]), 0.0)
    unseen = fit_steps(store, (START, cut), (ALL[1], ALL[1]), 0.0, rounds=2, patience=None)
    assert all(np.isnan(s["val_mae"]) for s in unseen.steps)


def test_store_holds_each_value_about_once(spark, two_channels, tmp_path):
    store = store_of(two_channels, seq_len=36, chunk="1 day")
    values = store.chunks.agg(F.sum(F.size("z")), F.sum(F.size("pos"))).first()
    windows = store.windows().count()
    assert values[1] == windows == store.targets().count() == store.counts(ALL)[0] and windows > 1000
    assert values[0] < 1.3 * two_channels.count()
    both = store.windows().select("linkid", "end_time", "y").subtract(store.targets())
    assert both.count() == 0
    half = (START, START + timedelta(hours=30))
    assert store.windows(half).count() == store.counts(half)[0] == store.windows().filter(
        F.unix_micros("end_time").between(*map(to_micros, half))
    ).count()
    assert 0 < store.scratch.size() and len(store.scratch.paths) == 1
    path = store.scratch.paths[0]
    store.release()
    assert not store.scratch.paths and store.scratch.size() == 0
    with pytest.raises(Exception, match=path.rsplit("/", 1)[-1]):
        store.windows().count()


def test_run_on_the_events(spark):
    """Held-out error below the last value's, and scratch of the windows within twice the series."""
    data = training_set(prepare_series(gold_by_type(spark, f"{ROOT}/sf0.01"), DAYS_CONFIG), DAYS_CONFIG)
    fitted, scores = train_and_score(data, DAYS_CONFIG)
    by = {(r.model, r.side): r for r in scores.collect()}
    assert by["l1", "validation"].mae < 0.995 * by["persistence", "validation"].mae
    assert by["l1", "train"].mae < 0.995 * by["persistence", "train"].mae
    assert by["l1", "validation"].mae == pytest.approx(fitted.steps[fitted.best]["val_mae"])
    assert len(fitted.steps) > 5
    series = sum(f.stat().st_size for f in map(__import__("pathlib").Path, [p.removeprefix("file:") for p in data.series.inputFiles()]))
    assert data.store.scratch.size() + data.scratch.size() <= 2 * series
    last = evaluate(persistence(data.validation), data.threshold).first()
    assert by["persistence", "validation"].mae == pytest.approx(last.mae)
    data.release()


def test_forecast_query(spark):
    rows = forecast_eval(spark, f"{ROOT}/sf0.01").collect()
    assert {(r.model, r.side) for r in rows} == {(m, s) for m in ("l1", "persistence") for s in ("train", "validation")}
    assert all(0 < r.mae < 1 and 0 <= r.f1 <= 1 and r.tp + r.fn > 0 for r in rows)


def test_value_outside_the_channels(two_channels):
    cfg = TrainConfig(val_days=1, seq_len=8, channels=("flow",), value="speed", rounds=2)
    data = training_set(prepare_series(two_channels, cfg), cfg)
    assert cfg.measures == ["flow", "speed"] and set(data.scaler.columns) == {"linkid", "flow_mu", "flow_sd", "speed_mu", "speed_sd"}
    assert len(data.sequences.first().x) == 8 and len(fit(data, cfg).steps) == 3
    data.release()
