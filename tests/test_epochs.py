"""Places of an epoch: permutations of any size, unlike one another, without a shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from series_helpers import START, slots

from roadspeed.operators import epoch_order, permuted, window_store
from roadspeed.operators.epochs import numbered

ALL = (0, 4_000_000_000_000_000)


def places(spark, n, epoch=0, seed=42):
    return np.array([r[0] for r in spark.range(n).orderBy("id").select(permuted(F.col("id"), n, epoch, seed)).collect()])


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4099])
def test_permutation(spark, n):
    assert sorted(places(spark, n)) == list(range(n))


def test_epochs_look_random_and_unlike(spark):
    n = 4000
    orders = [places(spark, n, e, s) for e, s in ((0, 1), (1, 1), (0, 2))]
    orders.append(np.arange(n))
    for i, a in enumerate(orders):
        for b in orders[:i]:
            assert (a == b).sum() < 12 and abs(np.corrcoef(a, b)[0, 1]) < 0.06
    assert (orders[0] == places(spark, n, 0, 1)).all()
    steps = np.diff(orders[0])
    assert len(np.unique(steps)) > n / 3  # no lattice


@pytest.fixture
def store(spark):
    rows = [(k, t.isoformat(sep=" "), float(i % 17 + k)) for k in (1, 2, 3) for i, t in enumerate(slots(700))]
    df = spark.createDataFrame(rows, "linkid int, at string, self_mean double")
    df = df.select(F.col("linkid").cast("string"), F.col("at").cast("timestamp").alias("datetime"), "self_mean")
    return window_store(df, 6, fit_range=ALL, cols=["self_mean"])


def test_order_of_windows(store):
    n = store.counts(ALL)[0]
    rows, counted = numbered(store)
    assert counted == n and sorted(r.position for r in rows.select("position").collect()) == list(range(n))
    first, second = (epoch_order(store, epoch=e, batch=50).toPandas() for e in (0, 1))
    for order in (first, second):
        assert sorted(order["place"]) == list(range(n)) and order.groupby("batch").size().max() == 50
        assert (order["batch"] == order["place"] // 50).all()
    both = first.merge(second, on=["linkid", "end_time"])
    assert len(both) == n and (both["place_x"] == both["place_y"]).mean() < 0.01
    assert set(first.columns) == {"linkid", "end_time", "x", "y", "place", "batch"}
    part = (START, slots(300)[-1])
    some = epoch_order(store, part, values=False).toPandas()
    assert sorted(some["place"]) == list(range(store.counts(part)[0]))


def test_no_shuffle_and_no_sort(store):
    plan = epoch_order(store)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort " not in plan


def test_no_windows(store):
    nothing = (START.replace(year=2030), START.replace(year=2031))
    assert epoch_order(store, nothing).count() == 0
