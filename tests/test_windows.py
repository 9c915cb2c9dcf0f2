"""Split, scaler, windows and percentile against SQL and numpy."""

from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series_helpers import START, slots

from roadspeed.operators import (
    add_target, build_sequences, exact_percentile, expand_channels, fit_scaler, five_channels, restrict_links,
    shuffle_samples, split_by_time, standardise, time_span,
)
from roadspeed.operators.split import to_micros
from roadspeed.plans import TrainConfig, train_and_score, training_set

V = ["self_mean"]
ALL = (datetime(2000, 1, 1), datetime(2100, 1, 1))


def test_split_by_days(series):
    df = series({"a": [1.0] * 41}, step=timedelta(days=1))
    split = split_by_time(df, val_days=30)
    train, val = split.train(df), split.validation(df)
    assert train.count() == 10 and val.count() == 31
    assert train.agg(F.max("datetime")).first()[0] < val.agg(F.min("datetime")).first()[0]


def test_span_of_exactly_val_days_is_refused(series):
    with pytest.raises(ValueError, match="empty train"):
        split_by_time(series({"a": [1.0] * 31}, step=timedelta(days=1)), val_days=30)


def test_one_row_is_refused(series):
    with pytest.raises(ValueError, match="empty validation"):
        split_by_time(series({"a": [1.0]}))


@pytest.mark.parametrize("small", [100_000, 3])
@pytest.mark.parametrize("n", [1, 20])
def test_split_by_rows_takes_the_first_80_percent(series, n, small):
    links = [f"l{i}" for i in range(11)] + ["k", "l1x", "zz"]
    df = series({link: [1.0] * n for link in links})
    split = split_by_time(df, small=small)
    ordered = df.toPandas().sort_values(["datetime", "linkid"])
    size = int(len(ordered) * 0.8)
    got = split.train(df).toPandas().sort_values(["datetime", "linkid"])
    assert got[["datetime", "linkid"]].values.tolist() == ordered[["datetime", "linkid"]].head(size).values.tolist()
    assert split.validation(df).count() == len(ordered) - size


@pytest.mark.parametrize("small", [100_000, 3])
@pytest.mark.parametrize("keys", [["a", "b10", "b9", "é"], [1, 9, 10, 100, 11], [-3, -20, 5, 40, 0]], ids=["text", "long", "negative"])
def test_one_order_for_every_size_and_key_type(spark, keys, small):
    kind = "string" if isinstance(keys[0], str) else "long"
    df = spark.createDataFrame([(k, START.isoformat(sep=" "), 1.0) for k in keys], f"linkid {kind}, at string, self_mean double")
    df = df.select("linkid", F.col("at").cast("timestamp").alias("datetime"), "self_mean")
    split = split_by_time(df, train_frac=0.6, small=small)
    want = sorted(keys, key=lambda k: str(k).encode())[: int(len(keys) * 0.6)]
    assert sorted(r.linkid for r in split.train(df).collect()) == sorted(want)


@pytest.mark.parametrize("small", [100_000, 1])
def test_split_refuses_a_cut_among_equal_keys(series, small):
    df = series({"a": [1.0]})
    with pytest.raises(ValueError, match="more than one row"):
        split_by_time(df.union(df).union(df), small=small)


def test_restrict_links(series):
    df = series({"a": [1.0], "b": [1.0]})
    assert [r.linkid for r in restrict_links(df, df.filter("linkid = 'a'")).collect()] == ["a"]


def test_time_span(series):
    df = series({"a": [1.0] * 288, "b": [1.0] * 289})
    assert {r.linkid: r.total_days for r in time_span(df, "linkid").collect()} == {"a": 1, "b": 2}


def test_scaler_rules(series):
    df = series({"a": [1.0, 2.0, None, float("nan"), 3.0], "flat": [5.0, 5.0], "none": [None, None]})
    got = {r.linkid: (r.self_mean_mu, r.self_mean_sd) for r in fit_scaler(df, V, ALL).collect()}
    assert got["a"] == (2.0, pytest.approx(np.std([1, 2, 3]))) and got["flat"] == (5.0, 1.0) and got["none"] == (0.0, 1.0)


def test_scaler_range_is_closed_and_unseen_links_leave(series):
    df = series({"a": [1.0, 3.0, 100.0]}).union(series({"late": [1.0]}, start=START + timedelta(days=1)))
    scaler = fit_scaler(df, V, (START, START + timedelta(minutes=5)))
    assert [(r.linkid, r.self_mean_mu) for r in scaler.collect()] == [("a", 2.0)]
    assert sorted(r.self_mean for r in standardise(df, scaler, V).collect()) == [-1.0, 1.0, 98.0]


WINDOW_SQL = """
    WITH scale AS (
        SELECT linkid, coalesce(avg(v), 0) AS mu, coalesce(nullif(stddev_pop(v), 0), 1) AS sd FROM given GROUP BY linkid
    ),
    ahead AS (
        SELECT linkid, t, CAST((v - mu) / sd AS FLOAT) AS z,
               CAST((lead(v, {horizon}) OVER (PARTITION BY linkid ORDER BY t) - mu) / sd AS FLOAT) AS y
        FROM given JOIN scale USING (linkid)
    ),
    framed AS (
        SELECT linkid, t, y, list(z) OVER w AS x, count(z) OVER w AS filled
        FROM ahead WHERE y IS NOT NULL
        WINDOW w AS (PARTITION BY linkid ORDER BY t ROWS BETWEEN {seq_len} - 1 PRECEDING AND CURRENT ROW)
    )
    SELECT linkid, t, x, y FROM framed WHERE filled = {seq_len} AND t BETWEEN ? AND ?"""


def check_windows(df, seq_len, horizon, chunk, ends=None):
    """All windows, every element in its place, against SQL lists."""
    rows = build_sequences(df, seq_len, horizon, ALL, ends, cols=V, chunk=chunk).collect()
    got = {(r.linkid, r.end_time): (r.x, r.y) for r in rows}
    given = [(r.linkid, r.datetime, r.self_mean) for r in df.collect()]
    with duckdb.connect() as con:
        con.execute("CREATE TABLE given (linkid VARCHAR, t TIMESTAMP, v DOUBLE)")
        con.executemany("INSERT INTO given VALUES (?, ?, ?)", given)
        found = con.execute(WINDOW_SQL.format(seq_len=seq_len, horizon=horizon), list(ends or ALL)).fetchall()
    want = {(link, t): (x, y) for link, t, x, y in found}
    assert len(rows) == len(got) and got.keys() == want.keys()
    for k, (x, y) in want.items():
        np.testing.assert_allclose(got[k][0], x, rtol=1e-6, atol=1e-6)
        np.testing.assert_allclose(got[k][1], y, rtol=1e-6, atol=1e-6)
    return got


@pytest.mark.parametrize(
    "seq_len,horizon,chunk", [(36, 1, "1 day"), (36, 1, "1 hour"), (5, 3, "1 hour"), (1, 1, "1 hour"), (4, 13, "5 minutes")]
)
def test_windows_with_gaps(series, seq_len, horizon, chunk):
    rng = np.random.default_rng(seq_len)

    def link(n, missing):
        return [None if rng.random() < missing else float(rng.normal(50, 9)) for _ in range(n)]

    gap = link(60, 0) + [None] * 40 + link(60, 0)
    df = series({"full": link(150, 0), "few": link(150, 0.04), "gap": gap, "short": link(seq_len, 0), "none": [None] * 9})
    assert check_windows(df, seq_len, horizon, chunk)


def test_irregular_times(series, spark):
    rng = np.random.default_rng(5)
    steps = np.cumsum(rng.integers(1, 90_000, 200))
    pdf = pd.DataFrame({"linkid": "a", "datetime": pd.Timestamp(START) + pd.to_timedelta(steps, "s"), "self_mean": rng.normal(size=200)})
    assert check_windows(spark.createDataFrame(pdf), 7, 2, "1 day")


def test_counts_of_short_series(series):
    df = series({"a": [float(i) for i in range(40)], "b": [float(i) for i in range(36)]})
    got = build_sequences(df, 36, 1, ALL, cols=V).groupBy("linkid").count().collect()
    assert [(r.linkid, r["count"]) for r in got] == [("a", 4)]


def test_end_range_is_closed_and_history_may_precede(series):
    df = series({"a": [float(i % 7) for i in range(60)]})
    times = slots(60)
    got = check_windows(df, 10, 1, "1 hour", (times[20], times[25]))
    assert len(got) == 6


def test_window_bridges_a_dropped_row(series):
    values = [float(i) for i in range(8)]
    values[4] = None
    # Row 3 has no target and goes; row 4 has one but no value, which spoils the windows over it.
    got = check_windows(series({"a": values}), 2, 1, "1 day")
    assert [t.strftime("%H:%M") for _, t in sorted(got)] == ["00:05", "00:10", "00:30"]


def test_five_channels_in_windows(series):
    df = series({"a": [float(i) for i in range(12)]})
    wide = build_sequences(five_channels(df), 4, 1, ALL).orderBy("end_time")
    flat = expand_channels(build_sequences(df, 4, 1, ALL, cols=V)).orderBy("end_time")
    assert dict(wide.dtypes)["x"] == "array<array<float>>"
    assert [r.x for r in wide.collect()] == [r.x for r in flat.collect()]
    assert np.array(wide.first().x).shape == (4, 5)


def test_infinite_values_spoil_windows(series):
    got = build_sequences(series({"a": [1.0, float("inf"), 3.0, 4.0, 5.0, 6.0]}), 2, 1, ALL, cols=V)
    assert all(np.isfinite(r.x).all() for r in got.collect())


def test_target_over_chunks(series):
    values = [float(i) for i in range(20)]
    values[7] = None
    rows = add_target(series({"a": values}), horizon=3, chunk="10 minutes").orderBy("datetime").collect()
    assert [r.target for r in rows] == values[3:] + [None] * 3


def test_bad_arguments(series):
    df = series({"a": [1.0]})
    with pytest.raises(ValueError):
        add_target(df, horizon=0)
    with pytest.raises(ValueError):
        build_sequences(df, 0, 1, ALL)
    with pytest.raises(ValueError):
        build_sequences(df, 2, 1)


def test_rows_move_once_by_link_and_chunk(series, spark, tmp_path):
    """Exchanges by link alone carry the chunk table only (heads, tails)."""
    series({"a": [1.0] * 50}).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    plan = build_sequences(df, 3, 1, ALL, cols=V)._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(linkid#" in line and "_chunk" not in line.split("ENSURE")[0]:
            below = " ".join(lines[i + 1 : i + 3])
            assert "HashAggregate" in below or "_tail" in below, below


def test_shuffle_is_repeatable_and_whole(series):
    seq = build_sequences(series({"a": [float(i % 11) for i in range(60)]}), 3, 1, ALL, cols=V)
    one, two = ([r.end_time for r in shuffle_samples(seq, 7).collect()] for _ in range(2))
    other = [r.end_time for r in shuffle_samples(seq, 8).collect()]
    assert one == two != other and sorted(one) == sorted(other) and one != sorted(one)


CASES = {
    "normal": lambda rng: rng.normal(size=5000),
    "few values": lambda rng: rng.integers(0, 3, 5000).astype(float),
    "constant": lambda rng: np.full(5000, 2.5),
    "outliers": lambda rng: np.concatenate([rng.normal(size=5000), [1e300, -1e300]]),
    "straddle": lambda rng: np.repeat([1.0, 2.0], [251, 751]),
    "two": lambda rng: np.array([1.0, 2.0]),
    "one": lambda rng: np.array([4.0]),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("small,accuracy", [(1_000_000, 10_000), (50, 100), (50, 3)])
def test_percentile_is_exact(spark, name, small, accuracy):
    data = CASES[name](np.random.default_rng(3))
    df = spark.createDataFrame(pd.DataFrame({"y": np.concatenate([data, [np.nan]])})).repartition(3)
    for pct in (25.0, 37.3):
        assert exact_percentile(df, "y", pct, small, accuracy) == pytest.approx(np.percentile(data, pct), rel=1e-12)


def test_percentile_of_nothing(spark):
    with pytest.raises(ValueError):
        exact_percentile(spark.createDataFrame([(None,)], "y double"), "y", 25)


def test_training_set_flags_and_scores(series):
    rng = np.random.default_rng(1)
    day = 288
    base = [float(50 + 10 * np.sin(i / 20) + rng.normal()) for i in range(3 * day)]
    df = series({"a": base, "b": base[::-1]}).union(series({"late": base[:100]}, start=START + timedelta(days=2, hours=12)))
    cfg = TrainConfig(val_days=1, seq_len=12, rounds=5)
    data = training_set(df, cfg)
    assert {r.linkid for r in data.sequences.select("linkid").distinct().collect()} == {"a", "b"}
    assert data.train.count() == data.train_samples and data.validation.count() == data.val_samples
    assert data.threshold == pytest.approx(np.percentile([r.y for r in data.train.collect()], 25), rel=1e-9)
    last_train = data.train.agg(F.max(F.unix_micros("end_time"))).first()[0]
    assert last_train == data.fit_range[1] and data.val_range[0] > last_train
    assert np.array(expand_channels(data.sequences).first().x).shape == (12, 5)
    _, scores = train_and_score(data, cfg)
    got = {(r.model, r.side): r for r in scores.collect()}
    assert len(got) == 4 and got[("l1", "validation")].mae < 0.5


def test_training_set_without_windows(series):
    with pytest.raises(ValueError, match="no sequences"):
        training_set(series({"a": [1.0] * 30}), TrainConfig(seq_len=36))


def test_to_micros():
    assert to_micros(datetime(1970, 1, 2)) == 86_400_000_000 and to_micros(5) == 5
