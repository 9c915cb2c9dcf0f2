"""Whole texts as NumPy byte arrays inside Spark tasks, and the column helpers the operators share.

A *piece* is a run of consecutive texts of at most ``PIECE`` bytes in one array; a longer text is a piece of its own.
``bounds`` holds where each text of the piece starts, and the end. Nothing here looks across pieces, so memory is
bounded by the piece, not by the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of each piece of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, every[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def map_texts(
    docs: DataFrame, keep: list[str], text_col: str, fn: Callable[[np.ndarray, np.ndarray], list], added: str
) -> DataFrame:
    """The columns ``keep`` and, per text, what ``fn(bytes, bounds)`` returns: one array for each column of ``added``."""
    source = docs.select(*keep, F.col(text_col).alias("_whole_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    names = [*keep, *(x.split()[0] for x in added.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in pieces(batch.column(len(keep))):
                n = len(bounds) - 1
                columns = [batch.column(i).slice(first, n) for i in range(len(keep))]
                columns += [x if isinstance(x, pa.Array) else pa.array(x) for x in fn(data, bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, f"{kept}, {added}")


def table_of(values: tuple[int, ...]) -> np.ndarray:
    """A 256-entry lookup: is the byte one of ``values``?"""
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


IS_SPACE = table_of(_SPACES)


@cache
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = pow(int(_BASE), -1, 1 << 64) if inverse else int(_BASE)
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of the hash base modulo 2^64; only the length of a piece is kept between calls."""
    size = PIECE + 1
    return _powers(size, inverse)[:n] if n <= size else _powers.__wrapped__(n, inverse)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[0] = 0; any byte range is hashed from two entries by ``range_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_codes()[data] * powers(len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, the same for equal bytes anywhere."""
    shift = powers(len(prefix), inverse=True)
    return mix((prefix[ends] - prefix[starts]) * shift[starts] + (ends - starts).astype(np.uint64) * _BASE)


def word_ranges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the end): words end at ASCII white space and at text bounds."""
    n = len(data)
    inside = ~IS_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    before = cut.copy()
    before[1:] |= np.concatenate([~inside[:-1], [True]]) if n else True
    after = cut.copy()
    after[:-1] |= ~inside
    starts = np.flatnonzero(inside & before[:n])
    ends = np.flatnonzero(inside & after[1 : n + 1]) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes (len - width + 1 of them)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, width):
        out = out * _BASE + words[j : j + n]
    return mix(out)


def sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each range between two bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def crc_of_id(id_col: str) -> Column:
    """crc32 of the identifier as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))
