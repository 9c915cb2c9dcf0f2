import pytest

from roadspeed.operators import best_step, evaluate, persistence
from roadspeed.sinks import metrics_table

NAN = float("nan")


def test_scores(spark):
    rows = [(-2.0, -1.5), (-2.0, 0.0), (1.0, -1.5), (1.0, 1.0), (1.0, NAN)]
    got = evaluate(spark.createDataFrame(rows, "y double, pred double"), -1.0).first()
    assert (got.n, got.tp, got.fp, got.fn, got.f1) == (5, 1, 1, 1, 0.5)
    assert got.mae == pytest.approx(1.2)


def test_no_positives_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None)], "y double, pred double")
    assert evaluate(df, -1.0).first().f1 == 0.0
    nothing = evaluate(df.limit(0), -1.0).first()
    assert (nothing.n, nothing.mae, nothing.f1) == (0, 0.0, 0.0)


def test_best_step(spark):
    wide = spark.createDataFrame([(1, 0.5), (2, 0.4), (3, 0.4), (4, NAN)], "step int, val_mae double")
    assert best_step(metrics_table(wide, "r")).collect() == [("r", 2, 0.4)]


def test_persistence_flat_and_wide(spark):
    flat = spark.createDataFrame([([1.0, 2.0], 0.0)], "x array<float>, y float")
    wide = spark.createDataFrame([([[1.0] * 5, [1.0, 2.0, 3.0, 4.0, 5.0]], 0.0)], "x array<array<float>>, y float")
    assert persistence(flat).first().pred == 2.0 and persistence(wide).first().pred == 3.0
