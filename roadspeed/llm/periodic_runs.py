"""Periodic runs of words: stretches that repeat a block of words three times or more, and texts without the repeats.

A run is a maximal stretch of words of a text with smallest period q and at least ``max(least, 3 * q)`` words. Periods
below ``4 * base`` are found by comparing the text with itself at each lag. Longer ones come from minimizers at doubling
scales. A scale has windows of W places and grams of 3 W words, and looks for periods from 4 W to below 8 W:

* a gram that itself has a period of W or less lies inside a run that is known from smaller scales, and is passed over;
* the least hash of the other grams in each window is a minimizer. Inside a run the windows repeat at distance q, and so
  do their minimizers. A period has at least one gram that is not passed over, as grams that overlap in all but a word and
  all have short periods would share one, and the run would have it too; three periods hold it and its copy;
* pairs of equal minimizers at a distance of the scale's range are the seeds. Equal grams that are not passed over
  lie more than W apart, so a place has fewer than 8 partners in the range; no pair is left out;
* seeds are extended to both sides, and stretches shorter than 3 q are dropped.

So the result is that of comparing at all lags (up to 64-bit hash collisions, which could hide a seed; runs themselves are
compared word by word). Of stretches with the same ends only the smallest period is a run.

A text is handled as a whole inside one task; several short texts share a pass. Null, empty and blank texts have no words
and no runs. Each row is judged alone, so repeated rows and ids repeat their result and an empty table gives no rows.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.texts import map_texts, mix, powers

REPEATS = 3
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_SKIP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _stretches(same: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal stretches of at least ``shortest`` true flags."""
    edges = np.flatnonzero(same[1:] != same[:-1]) + 1
    edges = np.concatenate([[0] * bool(len(same) and same[0]), edges, [len(same)] * bool(len(same) and same[-1])])
    starts, ends = edges[::2].astype(np.int64), edges[1::2].astype(np.int64)
    long = ends - starts >= shortest
    return starts[long], ends[long]


def _at_lag(codes: np.ndarray, lag: int, least: int) -> np.ndarray:
    """Rows (start, length, lag) of the stretches that have this period."""
    starts, ends = _stretches(codes[:-lag] == codes[lag:], max(least - lag, (REPEATS - 1) * lag))
    return np.stack([starts, ends - starts + lag, np.full(len(starts), lag)], 1)


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """The least (or largest) of each ``width`` values in a row."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = least(values[:-step], values[step:])
        size += step
    return values


class _Hashed:
    """Hashes of any range of a sequence of codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes)), out=self.prefix[1:])
        self.shift = powers(len(codes) + 1, inverse=True)

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return (self.prefix[starts + lengths] - self.prefix[starts]) * self.shift[starts]

    def same(self, places: np.ndarray, lags: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.of(places, lengths) == self.of(places + lags, lengths)

    def reach(self, places: np.ndarray, lags: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from each place on (or before it) equal those a lag later; ``most`` at most."""
        low, high = np.zeros_like(most), most
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.same(places - middle if back else places, lags, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low


def _seeds(hashed: _Hashed, n: int, width: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances) of the pairs of equal minimizers at a distance from 4 to 8 times ``width``."""
    gram = REPEATS * width
    value = mix(hashed.of(np.arange(n - gram + 1), gram))
    value[value == _SKIP] = 0
    inside = known[(known[:, 2] <= width) & (known[:, 1] >= gram)]
    cover = np.zeros(len(value) + 1, np.int64)
    np.add.at(cover, inside[:, 0], 1)
    np.add.at(cover, inside[:, 0] + inside[:, 1] - gram + 1, -1)
    value[np.cumsum(cover)[:-1] > 0] = _SKIP
    padded = np.concatenate([np.full(width - 1, _SKIP), value, np.full(width - 1, _SKIP)])
    lowest = _sliding(padded, width, np.minimum)  # of the windows that hold a place, whole or cut by an end
    chosen = np.flatnonzero((_sliding(lowest, width, np.maximum) == value) & (value != _SKIP))
    chosen = chosen[np.argsort(value[chosen], kind="stable")]
    values = value[chosen]
    places, distances, ahead = [], [], 1
    while ahead < len(chosen):
        apart = np.where(values[ahead:] == values[:-ahead], chosen[ahead:] - chosen[:-ahead], 8 * width)
        if not (apart < 8 * width).any():
            break
        fits = (apart >= 4 * width) & (apart < 8 * width)
        places.append(chosen[:-ahead][fits])
        distances.append(apart[fits])
        ahead += 1
    none = np.empty(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *distances])


def _at_scale(codes: np.ndarray, width: int, least: int, known: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the stretches with periods from 4 to 8 times ``width``."""
    n, hashed = len(codes), _Hashed(codes)
    places, lags = _seeds(hashed, n, width, known)
    # Of a stretch with three periods, one whole period follows or precedes each of its places.
    after, before = places + 2 * lags <= n, places >= lags
    square = np.zeros(len(places), bool)
    square[after] = hashed.same(places[after], lags[after], lags[after])
    square[before] |= hashed.same(places[before] - lags[before], lags[before], lags[before])
    places, lags = places[square], lags[square]
    ends = places + hashed.reach(places, lags, n - places - lags, back=False)
    starts = places - hashed.reach(places, lags, places, back=True)
    long = ends - starts >= np.maximum(least - lags, (REPEATS - 1) * lags)
    found = np.unique(np.stack([starts, ends, lags], 1)[long], axis=0)
    exact = [bool((codes[s:e] == codes[s + q : e + q]).all()) for s, e, q in found]
    found = found[np.array(exact, bool)]
    return np.stack([found[:, 0], found[:, 1] - found[:, 0] + found[:, 2], found[:, 2]], 1)


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period, by start and period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def find_runs(codes: np.ndarray, ends: np.ndarray, least: int = 24, base: int = 8) -> np.ndarray:
    """Rows (start, length, period) by start and period, places in ``codes``.

    ``codes`` holds the word numbers of several texts; at ``ends`` each text has a closing number that occurs nowhere
    else, which no run can hold.
    """
    sizes = np.diff(ends, prepend=-1)
    base = max(base, -(-least // REPEATS))
    found = [np.empty((0, 3), np.int64)]
    found += [_at_lag(codes, lag, least) for lag in range(1, min(4 * base, len(codes)))]
    width = base
    while (long := sizes > 4 * REPEATS * width).any():
        at = np.flatnonzero(np.repeat(long, sizes))
        known = np.concatenate(found)
        known = known[np.repeat(long, sizes)[known[:, 0]]]
        new = known.copy()
        new[:, 0] = np.searchsorted(at, known[:, 0])
        seen = _at_scale(codes[at], width, least, new)
        seen[:, 0] = at[seen[:, 0]]
        found.append(seen)
        width *= 2
    return _smallest_periods(np.concatenate(found))


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those that a run holds after its first period, joined by a space."""
    if len(runs):
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
        words = list(compress(words, np.cumsum(cover)[:-1] == 0))
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, base: int = 8
) -> DataFrame:
    """(id, n_words, runs, collapsed) per row.

    ``runs`` is an array of (start, length, period) by start and period; starts count words from 0. ``collapsed`` is the
    text's words without those that a run holds after its first period, joined by one space.
    """

    def scan(data: np.ndarray, bounds: np.ndarray) -> list:
        raw = data.tobytes()
        texts = [raw[a:b].split() for a, b in zip(bounds[:-1], bounds[1:])]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        number = defaultdict(count().__next__)
        listed = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
        ends = np.cumsum(sizes + 1) - 1
        codes = np.empty(len(listed) + len(texts), np.int64)
        closing = np.zeros(len(codes), bool)
        closing[ends] = True
        codes[~closing], codes[closing] = listed, len(number) + np.arange(len(texts))
        runs = find_runs(codes, ends, least, base)
        text = np.searchsorted(ends, runs[:, 0])
        runs[:, 0] -= (ends - sizes)[text]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        parts = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"])
        kept = [_collapsed(words, runs[a:b]) for words, a, b in zip(texts, cuts[:-1], cuts[1:])]
        return [sizes, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), parts), pa.array(kept, pa.binary()).cast(pa.string())]

    return map_texts(docs, [id_col], text_col, scan, f"n_words bigint, runs {_RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period; of ties the first, then the one of the smallest period. Null: no run."""

    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line end for each run."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(line, "")
