"""Whitening of embedding vectors by their leading principal components.

Vectors are put on a grid of integers, and each distinct grid vector counts once in the fit. The components come from
Chebyshev-filtered subspace iteration. A pass is one Spark job over the stored fit list that returns V Q for a thin block Q,
where V is the covariance: each task centres its rows and adds up Xᵀ(X Q), and Spark sums the tasks' rows by dimension. V itself
is never made. A cycle

* applies a Chebyshev polynomial in V to the block by its three-term recurrence, a pass for each degree. It stays small on
  the unwanted spectrum, from a lower bound to the block's least Ritz value, and grows fast above;
* makes the block orthonormal (QR) and takes its Ritz vectors (Rayleigh-Ritz), with one pass;
* locks those whose residual |V q - e q| is at the rounding of the passes, and stops when all that are asked for are.

The lower bound comes from a Lanczos vector that travels along as one more column. The degree is such that the largest
unlocked value grows by at most ``GROWTH`` over the damped ones, so the block keeps its rank. The block has ``guard`` columns
more than are asked for; when four cycles do not certify it, it is doubled, up to all dimensions, where Rayleigh-Ritz is exact.

The driver holds the block, one number for each dimension and column. Centring is exact to rounding: a mean is a whole
number and a rest below one, and the whole part is taken off in integers.

Rows without a vector and vectors with null, NaN, infinite or huge entries (from ``LARGEST`` on) are dropped, as are vectors
whose length is not that of most rows (of equally frequent lengths the greater); repeated rows keep a result each. Components
are only those with variance, so there are fewer for few dimensions or rows, and no rows at all for a table with one vector or
none. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.session import materialise

LARGEST = 2.0**30
GROWTH = 1e7
_CHUNK = 1 << 18  # entries that a task centres at once
_BLOCK = 1 << 20  # entries of a stored block
Product = Callable[[np.ndarray], np.ndarray]


class _Lanczos:
    """A Lanczos process whose vector takes part in the passes of others; gives a lower bound of the spectrum."""

    def __init__(self, dims: int, rng: np.random.Generator, steps: int = 24) -> None:
        first = rng.standard_normal(dims)
        self.basis, self.diagonal, self.beside, self.steps = [first / np.linalg.norm(first)], [], [], min(steps, dims - 1)

    def through(self, product: Product, block: np.ndarray) -> np.ndarray:
        if len(self.diagonal) >= self.steps:
            return product(block)
        both = product(np.column_stack([block, self.basis[-1]]))
        rest = both[:, -1]
        self.diagonal.append(float(self.basis[-1] @ rest))
        basis = np.array(self.basis).T
        for _ in range(2):
            rest = rest - basis @ (basis.T @ rest)
        norm = float(np.linalg.norm(rest))
        self.beside.append(norm)
        if norm <= 1e-12 * abs(self.diagonal[0]):
            self.steps = len(self.diagonal)
        else:
            self.basis.append(rest / norm)
        return both[:, :-1]

    def lower_bound(self) -> float:
        if not self.diagonal:
            return 0.0
        side = self.beside[: len(self.diagonal) - 1]
        small = np.diag(self.diagonal) + np.diag(side, 1) + np.diag(side, -1)
        return max(0.0, float(np.linalg.eigvalsh(small)[0]) - self.beside[-1])


def _orthonormal(block: np.ndarray, locked: np.ndarray) -> np.ndarray:
    for _ in range(2):
        block = block - locked @ (locked.T @ block)
        block, _ = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))
    return block


def _filtered(through: Product, block: np.ndarray, image: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """The block under the Chebyshev polynomial that stays within ±1 on [low, high]."""
    centre, half = (high + low) / 2, (high - low) / 2
    degree = int(np.clip(np.log(2 * GROWTH) / np.arccosh(max((top - centre) / half, 1 + 1e-6)), 1, 24))
    before, now = block, (image - centre * block) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (through(now) - centre * now) / half - before
    return now


def leading(product: Product, dims: int, count: int, guard: int = 16, seed: int = 0, cycles: int = 4):
    """(values, vectors, residuals) of the ``count`` largest eigenvalues of the operator behind ``product``, falling."""
    rng = np.random.default_rng(seed)
    width, probe = min(dims, count + guard), _Lanczos(dims, rng)
    locked, locked_values, locked_rest = np.empty((dims, 0)), np.empty(0), np.empty(0)
    block = _orthonormal(rng.standard_normal((dims, width)), locked)
    best, done = np.inf, 0
    while True:
        image = probe.through(product, block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, block, image = values[order], block @ turn[:, order], image @ turn[:, order]
        rest = np.linalg.norm(image - block * values, axis=0)
        top = max(values[0] if len(values) else 0.0, locked_values.max(initial=0.0))
        needed = max(0, min(count, dims) - len(locked_values))
        worst = rest[:needed].max(initial=0.0)
        whole = len(locked_values) + block.shape[1] >= dims
        settled = worst <= 1e-12 * top and worst > best / 2
        if whole or settled or worst <= 4e-15 * np.sqrt(dims) * top:
            values = np.concatenate([locked_values, values])
            vectors, rest = np.column_stack([locked, block]), np.concatenate([locked_rest, rest])
            order = np.argsort(-values, kind="stable")[: min(count, dims)]
            return values[order], vectors[:, order], rest[order]
        best = min(best, worst)
        fixed = int(np.argmin(np.append(rest <= 4e-15 * np.sqrt(dims) * top, False)))  # leading ones that are at rounding
        if fixed:
            locked = np.column_stack([locked, block[:, :fixed]])
            locked_values, locked_rest = np.append(locked_values, values[:fixed]), np.append(locked_rest, rest[:fixed])
            block, image, values, best = block[:, fixed:], image[:, fixed:], values[fixed:], np.inf
        high = max(values[-1], 1e-14 * top)
        low = min(probe.lower_bound(), high / 2 if high <= probe.lower_bound() else high)
        if high - low < 1e-3 * high:
            low = 0.0
        block = _filtered(lambda q: probe.through(product, q), block, image, low, high, values[0])
        done += 1
        if done % cycles == 0:
            more = min(dims - len(locked_values), 2 * block.shape[1]) - block.shape[1]
            block, best = np.column_stack([block, rng.standard_normal((dims, more))]), np.inf
        block = _orthonormal(block, locked)


@dataclass(frozen=True)
class Whitening:
    """What a fit knows; ``components`` has a column for each component."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float
    scale: float
    shift: int


def _on_grid(flat: np.ndarray, dims: int, scale: float, shift: int) -> np.ndarray:
    return np.floor(scale * flat.astype(np.float64)).astype(np.int64).reshape(-1, dims) + shift


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole part, rest times n, rest) of the means."""
    whole = [s // n for s in sums]
    over = [s - n * w for s, w in zip(sums, whole)]
    return np.array(whole, np.int64), np.array(over, np.int64), np.array([o / n for o in over])


def usable(vectors: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """The rows with a sound vector of the usual length, and that length (0 without any)."""
    sound = vectors.filter(F.forall(F.col(vector_col), lambda v: F.coalesce(F.abs(v) < LARGEST, F.lit(False))))
    lengths = sound.groupBy(F.size(vector_col).alias("dims")).count().filter("dims > 0")
    usual = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    dims = usual["dims"] if usual else 0
    return sound.filter(F.size(vector_col) == dims), dims


def _fit_list(rows: DataFrame, vector_col: str, dims: int, scale: float, shift: int) -> DataFrame:
    """(n, sums, width, x): the distinct grid vectors in blocks, ``width`` bytes an entry."""

    def on_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = _on_grid(batch.column(0).flatten().to_numpy(zero_copy_only=False), dims, scale, shift)
            stored, step = grid.astype("<i8").tobytes(), 8 * dims
            yield pa.RecordBatch.from_arrays([pa.array([stored[i * step : (i + 1) * step] for i in range(len(grid))], pa.binary())], ["x"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            grid = np.frombuffer(b"".join(held), "<i8").reshape(-1, dims)
            width = 4 if np.abs(grid).max() < 2**31 else 8
            values = [[len(grid)], [grid.sum(0).tolist()], [width], [grid.astype(f"<i{width}").tobytes()]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["n", "sums", "width", "x"])

        for batch in batches:
            for x in batch.column(0):
                held.append(x.as_py())
                size += dims
                if size >= _BLOCK:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    distinct = rows.select(F.col(vector_col).cast("array<double>")).mapInArrow(on_grid, "x binary").distinct()
    return materialise(distinct.mapInArrow(packed, "n bigint, sums array<bigint>, width int, x binary"), "fit-list")


def _pass(blocks: DataFrame, n: int, sums: list[int], q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(V q, diagonal of V) by one job over the fit list."""
    dims, columns = q.shape
    whole, _, rest = _mean(sums, n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((dims, columns + 1)), False
        for batch in batches:
            for width, stored in zip(batch.column(0), batch.column(1)):
                some = True
                grid = np.frombuffer(stored.as_buffer(), f"<i{width.as_py()}").reshape(-1, dims)
                for at in range(0, len(grid), max(1, _CHUNK // dims)):
                    centred = (grid[at : at + max(1, _CHUNK // dims)] - whole) - rest
                    total[:, :-1] += centred.T @ (centred @ q)
                    total[:, -1] += np.einsum("ij,ij->j", centred, centred)
        if some:
            flat = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), columns + 1).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), flat], ["dim", "part"])

    parts = blocks.select("width", "x").mapInArrow(add, "dim int, part array<double>")
    summed = parts.groupBy("dim").agg(F.array(*(F.sum(F.col("part")[j]) for j in range(columns + 1))).alias("part"))
    out = np.zeros((dims, columns + 1))
    for dim, part in summed.collect():  # a row for each dimension
        out[dim] = part
    return out[:, :-1] / n, out[:, -1] / n


def fit(
    vectors: DataFrame, vector_col: str = "embedding", components: int = 16, scale: float = 64.0, shift: int = 1_000_000,
    guard: int = 16, seed: int = 0,
) -> Whitening | None:
    """Components of the distinct vectors ``floor(scale * entry) + shift``; None without any vector."""
    rows, dims = usable(vectors, vector_col)
    if not dims:
        return None
    blocks = _fit_list(rows, vector_col, dims, scale, shift)
    whole = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    by_dim = blocks.select("n", F.posexplode("sums").alias("dim", "sum")).groupBy("dim").agg(F.sum("n").alias("n"), whole)
    counted = sorted(by_dim.collect())  # a row for each dimension
    n, sums = counted[0]["n"], [int(r["sum"]) for r in counted]

    def product(q: np.ndarray) -> np.ndarray:
        return _pass(blocks, n, sums, q)[0]

    values, found, rest = leading(product, dims, components, guard, seed)
    found = found * np.where(found[np.abs(found).argmax(0), np.arange(found.shape[1])] < 0, -1.0, 1.0)
    image, diagonal = _pass(blocks, n, sums, found)
    trace = float(diagonal.sum())
    varies = values > 1e-12 * trace
    values, found, rest, image = values[varies], found[:, varies], rest[varies], image[:, varies]
    spread = found.T @ image / np.sqrt(np.outer(values, values))  # the covariance of the whitened fit list
    error = float(np.abs(spread - np.eye(len(values))).max(initial=0.0))
    return Whitening(n, sums, found, values, rest, trace, error, scale, shift)


def _deviations(grid: np.ndarray, over: np.ndarray, n: int) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)², given x less the means' whole part; null beyond 64 bits."""
    square, cross = np.einsum("ij,ij->i", grid, grid), grid @ over
    rest = sum(o * o for o in over.tolist())
    exact = [n * n * a - 2 * n * b + rest for a, b in zip(square.tolist(), cross.tolist())]
    return [x if x < 2**63 else None for x in exact]


def transform(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened): per sound row its deviation and an array with a value for each component."""
    source = vectors.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("_vector"))
    schema = f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, deviation bigint, whitened array<double>"
    if model is None:
        return source.limit(0).select(F.col(id_col), F.lit(None).cast("bigint").alias("deviation"), F.col("_vector").alias("whitened"))
    rows, dims = usable(source, "_vector")
    whole, over, rest = _mean(model.sums, model.n)
    axes, n, scale, shift = model.components / np.sqrt(model.values), model.n, model.scale, model.shift

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = _on_grid(batch.column(1).flatten().to_numpy(zero_copy_only=False), dims, scale, shift) - whole
            white = (grid - rest) @ axes
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(grid) + 1) * axes.shape[1], pa.int32()), pa.array(white.ravel())
            )
            columns = [batch.column(0), pa.array(_deviations(grid, over, n), pa.int64()), values]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "deviation", "whitened"])

    return rows.mapInArrow(project, schema)


def by_component(whitened: DataFrame, model: Whitening | None, id_col: str = "vec_id") -> DataFrame:
    """A row for each row and component, numbered from 1, with what the fit knows."""
    n, trace, error = (model.n, model.trace, model.identity_error) if model else (0, 1.0, 0.0)
    shares: Column = F.array(*(F.lit(float(v / trace)) for v in model.values)) if model else F.array().cast("array<double>")
    long = whitened.select(F.col(id_col), "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return long.select(
        F.col(id_col), (F.col("_at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("_at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
