"""Grid and imputation against SQL and hand-made series, and on hot links."""

import sys
from datetime import timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from series_helpers import START, slots

from roadspeed.operators import complete_grid, dedupe_mean, five_channels, impute, impute_rolling, impute_seasonal
from roadspeed.operators import grid as grid_module

V = ["self_mean"]
impute_module = sys.modules["roadspeed.operators.impute"]  # the package has a function of this name


def collected(df, col="self_mean"):
    rows = df.orderBy("linkid", "datetime").toPandas()
    return {link: part.set_index("datetime")[col] for link, part in rows.groupby("linkid")}


def test_moving_mean_of_nine_slots(series):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    got = collected(impute_rolling(series({"a": values}), V))["a"]
    assert got.tolist() == [1.0, 2.0, pytest.approx(3.6), 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    nan = collected(impute_rolling(series({"a": [float("nan") if v is None else v for v in values]}), V))["a"]
    assert nan.tolist() == got.tolist()


def test_every_position_of_the_moving_mean(series, spark):
    """Each slot in turn is the missing one: the means known for the nine-slot example."""
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    known = pd.Series(values, index=pd.DatetimeIndex(slots(9))).rolling("31min", center=True, min_periods=1).mean()
    assert known.round(4).tolist() == [2.3333, 3.0, 3.6, 4.1667, 5.3333, 6.5, 6.5, 7.0, 7.5]


GRID_SQL = """
    WITH readings AS (SELECT linkid, datetime, avg(v) AS v FROM given GROUP BY ALL),
    grid AS (
        SELECT linkid, datetime, v
        FROM (SELECT linkid, unnest(generate_series(min(datetime), max(datetime), INTERVAL '5 minutes')) AS datetime
              FROM readings GROUP BY linkid) LEFT JOIN readings USING (linkid, datetime)
    ),
    near AS (
        SELECT linkid, datetime, coalesce(v, avg(v) OVER (
            PARTITION BY linkid ORDER BY epoch_us(datetime)
            RANGE BETWEEN 929999999 PRECEDING AND 930000000 FOLLOWING)) AS v
        FROM grid
    )
    SELECT linkid, datetime, coalesce(v, avg(v) OVER (
        PARTITION BY linkid, isodow(datetime), strftime(datetime, '%H:%M'))) AS v
    FROM near ORDER BY linkid, datetime"""


def random_rows(seed, n=400, days=16):
    """Readings of three links, one of them hot, at random slots; some twice, some without a value."""
    rng = np.random.default_rng(seed)
    links = rng.choice(["a", "b", "hot"], n, p=[0.2, 0.2, 0.6])
    slot, value, empty = rng.integers(0, days * 288, n), rng.normal(50, 10, n), rng.random(n) < 0.1
    return [
        (str(link), START + timedelta(minutes=5 * int(s)), None if gone else float(round(v, 2)))
        for link, s, v, gone in zip(links, slot, value, empty)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_impute_agrees_with_sql(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame([(k, t.isoformat(sep=" "), v) for k, t, v in rows], "linkid string, datetime string, self_mean double")
    got = [(r.linkid, r.datetime, r.self_mean) for r in impute(df, V).orderBy("linkid", "datetime").collect()]
    with duckdb.connect() as con:
        con.execute("CREATE TABLE given (linkid VARCHAR, datetime TIMESTAMP, v DOUBLE)")
        con.executemany("INSERT INTO given VALUES (?, ?, ?)", rows)
        want = con.execute(GRID_SQL).fetchall()
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for (*_, mine), (*_, theirs) in zip(got, want):
        assert mine == (None if theirs is None else pytest.approx(theirs, rel=1e-12))


def test_moving_mean_across_chunks(series):
    """Gaps on both sides of every midnight of a week."""
    n = 7 * 288
    values = [None if i % 288 in (0, 1, 286, 287) else float(i % 97) for i in range(n)]
    got = collected(impute_rolling(series({"a": values}), V))["a"]
    known = pd.Series(values, index=pd.DatetimeIndex(slots(n)), dtype=float)
    want = known.fillna(known.rolling("31min", center=True, min_periods=1).mean())
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_seasonal_fill_after_rolling(series):
    """A gap of an hour whose inner slots have no close neighbour is filled from a week later."""
    week = 7 * 288
    values = [float(10 + i % 5) for i in range(week + 60)]
    values[20:32] = [None] * 12
    got = collected(impute(series({"a": values}), V))["a"]
    assert got.notna().all()
    assert got.iloc[26] == values[week + 26]
    assert got.iloc[20] == pytest.approx(np.mean(values[17:20]))


def test_seasonal_mean_counts_rolled_values(series):
    week = 7 * 288
    values = [None] * (2 * week + 1)
    values[0], values[3], values[week] = 10.0, 40.0, 30.0
    got = collected(impute(series({"a": values[:week * 2 + 1]}), V))["a"]
    # The grid ends with the last row, which is present although its value is missing.
    assert got.iloc[2 * week] == pytest.approx(20.0)


def test_off_grid_rows_vanish_and_duplicates_average(spark):
    rows = [("a", "2025-11-13 00:00:00", 1.0), ("a", "2025-11-13 00:05:00", 2.0), ("a", "2025-11-13 00:05:00", 4.0),
            ("a", "2025-11-13 00:07:00", 9.0), ("a", "2025-11-13 00:15:00", None), (None, "2025-11-13 00:00:00", 1.0),
            ("a", "x", 5.0), ("a", None, 5.0), ("a", "2025-11-13T00:10", 7.0)]
    df = spark.createDataFrame(rows, "linkid string, datetime string, self_mean double")
    got = collected(complete_grid(df, V))["a"]
    assert got.index.strftime("%H:%M").tolist() == ["00:00", "00:05", "00:10", "00:15"]
    assert got.tolist()[:3] == [1.0, 3.0, 7.0] and np.isnan(got.iloc[3])


def test_grid_starts_at_each_links_first_time(series):
    from pyspark.sql import DataFrame

    a = series({"a": [1.0, 2.0]}, start=START + timedelta(minutes=2), step=timedelta(minutes=10))
    b = series({"b": [3.0]})
    got = collected(complete_grid(DataFrame.unionByName(a, b), V))
    assert got["a"].index.strftime("%H:%M").tolist() == ["00:02", "00:07", "00:12"] and len(got["b"]) == 1


def test_blocks_of_slots_join_up(series, monkeypatch):
    monkeypatch.setattr(grid_module, "_BLOCK", 7)
    for n in (1, 7, 8, 14, 15, 50):
        got = collected(complete_grid(series({"a": [1.0] + [None] * (n - 2) + [2.0] * (n > 1)}), V))["a"]
        assert got.index.tolist() == [pd.Timestamp(t) for t in slots(n)]


def test_two_columns_are_filled_apart(spark, series):
    gold = series({"a": [1.0, None, 3.0]})
    wide = five_channels(gold).withColumn("f1_mean", F.lit(None).cast("double"))
    got = impute(wide, ["self_mean", "f1_mean"]).orderBy("datetime").collect()
    assert [r.self_mean for r in got] == [1.0, 2.0, 3.0] and [r.f1_mean for r in got] == [None] * 3


def test_dedupe_skips_null_and_nan(spark):
    rows = [("a", 1, 2.0), ("a", 1, float("nan")), ("a", 1, None), ("a", None, 1.0), ("b", 1, float("nan"))]
    got = dedupe_mean(spark.createDataFrame(rows, "k string, t int, v double"), ["k", "t"], ["v"])
    assert {r.k: r.v for r in got.collect()} == {"a": 2.0, "b": None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=2, max_size=40))
def test_imputation_keeps_known_values(series, values):
    got = collected(impute(series({"a": values}), V))["a"]
    assert len(got) == len(values)
    assert all(v is None or v == g for v, g in zip(values, got))


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]


def test_imputation_shuffles_readings_once_and_slots_once(series, monkeypatch):
    monkeypatch.setattr(grid_module, "_TASK_SLOTS", 500)
    df = series({"a": [1.0, None, 3.0] * 500, "b": [2.0]})
    after, readings = exchanges(impute(df, V))
    assert "hashpartitioning(linkid" in readings and "_chunk" in readings and "hashpartitioning(linkid" in after
    assert len(exchanges(complete_grid(df, V))) == 1


@pytest.mark.parametrize("block", [1, 2, 7])
def test_chunks_without_readings_and_edges(spark, monkeypatch, block):
    """Chunks of a few slots, most of them empty: the same result as with long ones."""
    rows = [(k, t.isoformat(sep=" "), v) for k, t, v in random_rows(7, n=60, days=1)]
    df = spark.createDataFrame(rows, "linkid string, datetime string, self_mean double")
    want = complete_grid(df, V).orderBy("linkid", "datetime").collect()
    filled = impute(df, V).orderBy("linkid", "datetime").collect()
    monkeypatch.setattr(grid_module, "_BLOCK", block)
    monkeypatch.setattr(impute_module, "_BLOCK", block)
    monkeypatch.setattr(impute_module, "_FRAMES_PER_CHUNK", 1)
    assert complete_grid(df, V).orderBy("linkid", "datetime").collect() == want
    got = impute(df, V).orderBy("linkid", "datetime").collect()
    assert [r[:2] for r in got] == [r[:2] for r in filled]
    assert all(a == b or abs(a - b) < 1e-9 for a, b in ((x.self_mean, y.self_mean) for x, y in zip(got, filled)) if a is not None)
    assert [r.self_mean is None for r in got] == [r.self_mean is None for r in filled]


def test_grid_of_nothing(series):
    empty = series({"a": [1.0]}).limit(0)
    assert complete_grid(empty, V).count() == 0 and impute(empty, V).count() == 0


def test_windows_hold_a_chunk_not_a_link(series):
    """The only partitioning of rows by link alone would be a hot task."""
    plan = impute_rolling(series({"a": [1.0]}), V)._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in [line for line in plan.splitlines() if "hashpartitioning" in line][0]
