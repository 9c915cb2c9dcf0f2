"""Whitening against a dense eigensolver, and its laws."""

import numpy as np
import pytest

from check import ROOT
from roadspeed.llm import whitening
from roadspeed.llm.queries import op11_whitening
from roadspeed.llm.whitening import by_component, fit, leading, transform

SCHEMA = "vec_id bigint, embedding array<float>, n int, whitened string, _at int"


def spectrum(kind, dims):
    rng = np.random.default_rng(1)
    return {
        "flat": np.linspace(58, 66, dims), "dominant": np.r_[1e9, 1e5, 404, 133, np.linspace(47, 69, dims - 4)],
        "decaying": 0.7 ** np.arange(dims), "rank": np.r_[np.arange(5.0, 0, -1), np.zeros(dims - 5)],
        "equal": np.full(dims, 3.0), "close": np.r_[np.full(15, 9.0), 5 + rng.random(dims - 15) * 1e-4],
    }[kind]


@pytest.mark.parametrize("dims", [40, 150])
@pytest.mark.parametrize("kind", ["flat", "dominant", "decaying", "rank", "equal", "close"])
def test_leading_eigenvalues(kind, dims):
    rng = np.random.default_rng(2)
    wanted = np.sort(spectrum(kind, dims))[::-1]
    turn, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    matrix = (turn * wanted) @ turn.T
    passes = []
    values, vectors, rest = leading(lambda q: passes.append(q.shape) or matrix @ q, dims, 16)
    assert np.abs(values - wanted[:16]).max() <= 1e-12 * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() <= 2e-12 * wanted[0]
    assert len(passes) < 260 and max(shape[1] for shape in passes) <= dims + 1


def dense(rows, dims=None):
    """(fit list's n, S, values and vectors) in plain numpy."""
    grid = np.unique(np.floor(64 * np.array(rows, np.float32).astype(float)).astype(np.int64) + 1_000_000, axis=0)
    n, sums = len(grid), grid.sum(0)
    centred = (n * grid - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1], vectors[:, ::-1]


def check(rows, ids, got):
    n, sums, values, vectors = dense(rows)
    count = min(16, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == len(rows) * count
    table = {k: part.sort_values("component") for k, part in got.groupby("vec_id")}
    signs = None
    for i, row in zip(ids, rows):
        x = np.floor(64 * np.array(row, np.float32).astype(float)).astype(np.int64) + 1_000_000
        exact = n * x - sums
        part = table[i]
        assert part["component"].tolist() == list(range(1, count + 1)) and set(part["n"]) == {n}
        assert set(part["deviation"]) == {int((exact.astype(object) ** 2).sum())}
        white = exact / n @ vectors[:, :count] / np.sqrt(values[:count])
        signs = np.sign(white * part["whitened"]) if signs is None else signs
        assert np.abs(white * signs - part["whitened"].to_numpy()).max() < 1e-7
        assert np.abs(part["explained"] / (values[:count] / values.sum()) - 1).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_query(spark):
    got = op11_whitening(spark, f"{ROOT}/sf0.001").toPandas()
    table = spark.read.parquet(f"{ROOT}/sf0.001/embeddings.parquet").toPandas()
    check([list(v) for v in table["embedding"]], table["vec_id"], got)


def whitened(df):
    model = fit(df)
    return by_component(transform(df, model), model)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    sound = rng.standard_normal((60, 5)).astype(np.float32).tolist()
    sound += [sound[0]] * 25 + [[1e3, -1e3, 0.0, 0.0, 1.0]]
    odd = [None, [], [None] * 5, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1e30] * 5, [1.0] * 3]
    rows = [(i, v, 1, "x", 2) for i, v in enumerate(sound)] + [(1000 + i, v, None, None, None) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(sound, range(len(sound)), whitened(df).toPandas())
    again = whitened(df.union(df.filter("vec_id = 3"))).toPandas()
    assert len(again) == 5 * (len(sound) + 1) and set(again["n"]) == {61}
    for few in (df.limit(0), df.filter("vec_id >= 1000 AND vec_id < 1007"), df.filter("vec_id = 0"), df.filter("vec_id IN (0, 60, 61)")):
        assert whitened(few).count() == 0
    assert [r.component for r in whitened(df.filter("vec_id < 2")).collect()] == [1, 1]


def test_deviation_beyond_64_bits_is_null():
    grid, over = np.array([[1, -2], [2**30, 5]]), np.array([3, 10**9 - 1])
    n = 10**9
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, over.tolist())) for row in grid.tolist()]
    assert whitening._deviations(grid, over, n) == [exact[0] if exact[0] < 2**63 else None, None]
    assert whitening._deviations(grid[:1], np.array([3, 4]), 10) == [7**2 + 24**2]
