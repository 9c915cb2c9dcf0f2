"""Trailing moments and percentiles against plain computation over each range."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series_helpers import START

import roadspeed.operators.trailing as trailing
from roadspeed.operators.trailing import (
    TrailingState, daily_moments, daily_sketches, deviation, shifted, trailing_moments, trailing_percentiles,
)

V = "self_mean"


def frame(seed=1, n=3000, days=25, far=0.0):
    """Readings of three links, one of them hot and one with days without any; some NULL, some NaN."""
    rng = np.random.default_rng(seed)
    link = rng.choice(["a", "b", "hot"], n, p=[0.2, 0.1, 0.7])
    minute = rng.integers(0, days * 1440, n)
    minute = np.where((link == "b") & (minute // 1440 % 9 < 5), minute % 1440, minute)
    value = far + rng.normal(50, 10, n).round(2)
    value[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"linkid": link, "datetime": [pd.Timestamp(START) + timedelta(minutes=int(m)) for m in minute], V: value})


@pytest.fixture
def rows(spark):
    def make(pdf):
        return spark.createDataFrame(pdf).withColumn("datetime", F.col("datetime").cast("timestamp"))
    return make


def plain(pdf, link, day, days):
    own = pdf[(pdf["linkid"] == link) & (pdf["datetime"].dt.date <= day) & (pdf["datetime"].dt.date > day - timedelta(days=days))]
    v = own[V].dropna()
    return len(v), v.mean() if len(v) else 0.0, v.std(ddof=0) if len(v) else None


@pytest.mark.parametrize("days,far", [(1, 0.0), (7, 0.0), (30, 0.0), (7, 1e7)])
def test_moments_of_every_range(rows, days, far):
    pdf = frame(far=far)
    got = trailing_moments(daily_moments(rows(pdf), [V]), [V], days).withColumn("sd", deviation(V)).collect()
    assert len(got) == len(pdf.groupby(["linkid", pdf["datetime"].dt.date]))
    for r in got:
        n, mean, sd = plain(pdf, r.linkid, r.day, days)
        assert r[f"{V}_n"] == n and r[f"{V}_mean"] == pytest.approx(mean, rel=1e-9)
        assert (r.sd is None) if sd is None else r.sd == pytest.approx(sd, rel=1e-9, abs=1e-6 if far else 1e-9)


def test_state_moves_on_by_reading_two_days(spark, rows, tmp_path, monkeypatch):
    pdf = frame(seed=3)
    state = TrailingState(spark, str(tmp_path), [V], days=6)
    state.put(rows(pdf))
    read, seen = trailing.VersionedDays.read, []
    monkeypatch.setattr(trailing.VersionedDays, "read", lambda self, a, b, *x: seen.append((a, b)) or read(self, a, b, *x))
    for i in range(4, 20):
        day = START.date() + timedelta(days=i)
        seen.clear()
        got = {r.linkid: r for r in state.advance(day.strftime("%Y%m%d")).collect()}
        if i > 4:
            assert all(a == b for a, b in seen) and len({a for a, _ in seen}) <= 4  # state before, two days, state after
        for link in ("a", "b", "hot"):
            n, mean, sd = plain(pdf, link, day, 6)
            assert (link in got) == (n > 0)
            if n:
                assert got[link][f"{V}_n"] == n and got[link][f"{V}_mean"] == pytest.approx(mean, rel=1e-9)
                assert (got[link][f"{V}_m2"] / n) ** 0.5 == pytest.approx(sd, rel=1e-7, abs=1e-6)
    anew = {r.linkid: r for r in state.rebuild(day.strftime("%Y%m%d")).collect()}
    assert anew.keys() == got.keys() and all(anew[k][f"{V}_n"] == got[k][f"{V}_n"] for k in got)


def test_taking_a_day_away_undoes_adding_it(rows):
    daily = daily_moments(rows(frame(seed=5, days=3)), [V])
    first, second = (daily.filter(F.col("day") == date(2025, 11, 13 + i)).drop("day") for i in (0, 1))
    both = shifted(first, second, first.limit(0), [V])
    back = {r.linkid: r for r in shifted(both, first.limit(0), second, [V]).collect()}
    for r in first.collect():
        assert back[r.linkid][f"{V}_n"] == r[f"{V}_n"] and back[r.linkid][f"{V}_mean"] == pytest.approx(r[f"{V}_mean"])
        assert back[r.linkid][f"{V}_m2"] == pytest.approx(r[f"{V}_m2"], rel=1e-8)


@pytest.mark.parametrize("pct", [0.0, 25.0, 50.0, 99.5, 100.0])
def test_percentiles_are_exact(rows, pct):
    pdf = frame(seed=7, days=12)
    df = rows(pdf)
    got = {r.day: r for r in trailing_percentiles(df, daily_sketches(df, V), pct, V, days=4).collect()}
    by_day = pdf.dropna(subset=[V]).assign(day=lambda x: x["datetime"].dt.date)
    assert set(got) == set(by_day["day"])
    for day, r in got.items():
        v = by_day[(by_day["day"] <= day) & (by_day["day"] > day - timedelta(days=4))][V]
        assert r.n == len(v) and r.percentile == pytest.approx(np.percentile(v, pct), rel=1e-12)


def test_ranks_outside_their_bracket_are_searched_without_one(rows, monkeypatch):
    """Sketches of other values stand for bad luck."""
    pdf = frame(seed=9, days=3)
    df = rows(pdf)
    wrong = daily_sketches(df.withColumn(V, F.col(V) + 1000), V)
    got = {r.day: r.percentile for r in trailing_percentiles(df, wrong, 50.0, V, days=1).collect()}
    for day, part in pdf.dropna(subset=[V]).groupby(pdf["datetime"].dt.date):
        assert got[day] == pytest.approx(np.percentile(part[V], 50.0))


def test_nothing(rows):
    none = rows(frame(days=1)).limit(0)
    assert trailing_moments(daily_moments(none, [V]), [V]).count() == 0
    assert trailing_percentiles(none, daily_sketches(none, V), 25.0, V).count() == 0
