"""Benchmark decontamination by intact pieces of items and edit verification.

Texts and items are compared in a normal form: letters A-Z folded, other ASCII runs that are no letters or digits as one
space. Each item is cut into pieces of a length taken from its own length and edit bound: ``k`` edits leave all but ``k``
of the pieces intact, shifted by at most ``k`` against each other. So places where enough pieces of an item stand in line
are proposed, filtered by pieces of other lengths in the same way, which loses no passage, and verified by the edit distance
of the item to the text around, at most ``max_edits`` of the item's length.

Null and empty texts and items match nothing. The passage of an item shorter than ``q`` must stand as whole words. Equal
rows get equal results; an empty benchmark gives no hits. Only the named columns are read. Items go to the tasks in
blocks of bounded size, each block against all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.texts import PIECE, pieces, prefix_hash, range_hash

HITS = "array<struct<item:bigint,start:bigint,end:bigint,edits:int>>"
_FORM = np.full(256, 32, np.uint8)
_FORM[48:58], _FORM[97:123], _FORM[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_FORM[65:91] = np.arange(97, 123)
_MATCHES = 1 << 22  # matches of pieces that are counted at a time
_BANDS = 1 << 19  # bands of starts that are counted at a time, of texts that are not longer
_BEFORE = 1 << 24  # items are shorter
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 2048  # ranges whose distances are computed side by side


def normal_form(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bounds, place of each byte in ``data``) with runs of spaces as one and none at a text's start."""
    low = _FORM[data]
    blank = low == 32
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[edge[:-1] & blank] = False
    at = np.flatnonzero(keep)
    return low[at], np.searchsorted(at, bounds), at


def _codes(data: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """A number for each string of this length, or for those that start ``at`` some places: the string itself up to eight
    bytes, a 64-bit hash beyond."""
    n = max(0, len(data) - length + 1)
    if length > 8:
        at = np.arange(n) if at is None else at
        return range_hash(prefix_hash(data), at, at + length)
    codes = np.zeros(n if at is None else len(at), np.uint64)
    for j in range(length):
        codes <<= np.uint64(8)
        codes |= data[j : j + n] if at is None else data[at + j]
    return codes


class Strings:
    """A set of distinct codes that are looked up many at a time."""

    def __init__(self, distinct: np.ndarray) -> None:
        bits = max(16, int(16 * len(distinct)).bit_length())
        self.shift = np.uint64(64 - bits)
        slot = self._slot(distinct)
        self.order = np.argsort(slot, kind="stable")
        self.codes, slot = distinct[self.order], slot[self.order]
        self.more = np.append(slot[1:] == slot[:-1], False)  # the next code has the same slot
        self.first = np.zeros(1 << bits, np.int32)
        self.first[slot[::-1]] = np.arange(len(slot), dtype=np.int32)[::-1]
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[slot] = True

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * _SPREAD) >> self.shift).view(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which codes are in the set, their places in it)."""
        if not len(self.order):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        slot = self._slot(codes)
        at = np.flatnonzero(self.maybe[slot])
        place, codes = self.first[slot[at]], codes[at]
        known = self.codes[place] == codes
        rest = np.flatnonzero(~known & self.more[place])
        while len(rest):
            place[rest] += 1
            known[rest] = self.codes[place[rest]] == codes[rest]
            rest = rest[~known[rest] & self.more[place[rest]]]
        return at[known], self.order[place[known]]


@dataclass
class Items:
    """A block of items, prepared for search; what is derived from them is made where it is used."""

    numbers: list[int]
    texts: list[bytes]
    q: int
    max_edits: float

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(t) for t in self.texts], np.int64)

    @cached_property
    def bounds(self) -> np.ndarray:
        """How many edits each item may have."""
        return (self.max_edits * self.sizes).astype(np.int64)

    @cached_property
    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """(length of its pieces, how many of them are intact at least) of each item."""
        length, need = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes), np.int64)
        best = np.full(len(self.sizes), -1.0)
        for size in range(self.q, 0, -1):
            intact = self.sizes // size - self.bounds
            worth = np.where(intact > 0, intact * max(0.0, size - 3.5), -1)
            better = worth > best
            length[better], need[better], best[better] = size, intact[better], worth[better]
        return length, need

    @cached_property
    def grams(self) -> list[tuple[int, "Strings", np.ndarray, np.ndarray, np.ndarray]]:
        """(piece length, the distinct pieces, where the entries of each begin, item and offset of each entry)."""
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        begins, out = np.cumsum(self.sizes) - self.sizes, []
        for length in np.unique(self.pieces[0][self.pieces[0] > 0]):
            mine = np.flatnonzero(self.pieces[0] == length)
            n = self.sizes[mine] // length
            item = np.repeat(mine, n)
            offset = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * length
            codes = _codes(data, int(length))[begins[item] + offset]
            order = np.argsort(codes, kind="stable")
            distinct, first = np.unique(codes[order], return_index=True)
            out.append((int(length), Strings(distinct), np.append(first, len(codes)), item[order], offset[order]))
        return out

    def cut(self, n: int) -> tuple["Strings", np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pieces of ``n`` characters, the pieces of all items as places among them, where each item's begin, how
        many of them the bound leaves)."""
        if n not in self.cuts:
            data = np.frombuffer(b"".join(self.texts), np.uint8)
            count = self.sizes // n
            begins = np.cumsum(count) - count
            offset = (np.arange(count.sum()) - np.repeat(begins, count)) * n
            at = np.repeat(np.cumsum(self.sizes) - self.sizes, count) + offset
            distinct, places = np.unique(_codes(data, n)[at], return_inverse=True)
            self.cuts[n] = Strings(distinct), places.astype(np.int64), np.append(begins, count.sum()), count - self.bounds
        return self.cuts[n]

    @cached_property
    def cuts(self) -> dict[int, tuple]:
        return {}

    @cached_property
    def short(self) -> list[int]:
        return np.flatnonzero((self.sizes < self.q) & (self.sizes > 0)).tolist()

    def edits(self, i: int) -> int:
        return int(self.bounds[i])


def best_end(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(edits, end): the least edit distance of the pattern to any part of the text, and where the first such ends."""
    size, masks = len(pattern), {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << size - 1
    up, down, now, best = full, 0, size, (size, 0)
    for i, c in enumerate(text):
        match = masks.get(c, 0)
        cross = (((match & up) + up) ^ up) | match
        rise, fall = down | (~(cross | up) & full), up & cross
        now += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        vertical = match | down
        up, down = fall | (~(vertical | rise) & full), rise & vertical
        if now < best[0]:
            best = (now, i + 1)
    return best


def least_edits(patterns: list[bytes], which: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """The least edit distance of a pattern (by its number) to any part of each text, many texts side by side.

    The bit-parallel method of ``best_end``, with a column of 64-bit words for each text.
    """
    out = np.zeros(len(texts), np.int64)
    words = np.array([-(-len(p) // 64) for p in patterns], np.int64)[which] if len(which) else which
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    # Patterns of up to 8, 64, ... words go together: calls cost more than words that are not used.
    kind = np.ceil(np.log2(np.maximum(words, 1)) / 3).astype(np.int64)
    kind[words <= 8] = 1
    order = np.lexsort((lengths, kind))
    for one in np.unique(kind).tolist():
        same = order[kind[order] == one]
        for at in range(0, len(same), _ROWS):
            rows = same[at : at + _ROWS]
            used, own = np.unique(which[rows], return_inverse=True)
            some = [patterns[i] for i in used.tolist()]
            out[rows] = _side_by_side(some, own, [texts[i] for i in rows.tolist()], int(words[rows].max()))
    return out


def _side_by_side(patterns: list[bytes], own: np.ndarray, texts: list[bytes], n_words: int) -> np.ndarray:
    one, top = np.uint64(1), np.uint64(63)
    masks = np.zeros((len(patterns), 256, n_words), np.uint64)
    for i, pattern in enumerate(patterns):
        at = np.arange(len(pattern))
        chars = np.frombuffer(pattern, np.uint8)
        np.bitwise_or.at(masks, (i, chars, at >> 6), one << (at & 63).astype(np.uint64))
    size = np.array([len(p) for p in patterns], np.int64)[own]
    word, bit = (size - 1) >> 6, ((size - 1) & 63).astype(np.uint64)
    lengths, every = np.array([len(t) for t in texts], np.int64), np.arange(len(texts))
    steps = int(lengths.max())
    chars = np.frombuffer(b"".join(t.ljust(steps, b"\0") for t in texts), np.uint8).reshape(len(texts), steps).T.copy()
    up, down = np.full((n_words, len(texts)), ~np.uint64(0)), np.zeros((n_words, len(texts)), np.uint64)
    total, now, best = np.empty_like(up), size.copy(), size.copy()
    for step in range(steps):
        match = masks[own, chars[step]].T
        start, carry = match & up, None
        for w in range(n_words):
            np.add(start[w], up[w], out=total[w])
            over = total[w] < start[w]
            if carry is not None:
                total[w] += carry
                over |= total[w] < carry
            carry = over.astype(np.uint64)
        cross = (total ^ up) | match
        rise, fall = down | ~(cross | up), up & cross
        now += ((rise[word, every] >> bit) & one).astype(np.int64)
        now -= ((fall[word, every] >> bit) & one).astype(np.int64)
        for x in (rise, fall):
            above = x[:-1] >> top
            x <<= one
            x[1:] |= above
        vertical = match | down
        up, down = fall | ~(vertical | rise), rise & vertical
        np.minimum(best, now, out=best, where=step < lengths)
    return best


def _runs(lows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each of ``lows`` on, ``n`` of them."""
    return np.repeat(lows - np.cumsum(n) + n, n) + np.arange(n.sum())


def _flat(lows: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, row after i of each number, ``_runs``) for some rows i..j at a time."""
    ends, i = np.cumsum(n), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + _MATCHES, "right")))
        row = np.repeat(np.arange(j - i), n[i:j])
        yield i, j, row, (lows[i:j] - (ends[i:j] - n[i:j] - (ends[i] - n[i])))[row] + np.arange(len(row))
        i = j


def _bands(items: Items, gram: tuple, at: np.ndarray, place: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, ...]:
    """(item, band) of each two bands side by side that hold enough starts, for pieces found in begin..end.

    Starts are counted in an array with a place for each band where they are dense, by sorting where they are sparse.
    """
    _, _, begins, item_of, offset_of = gram
    used, wide = np.unique(item_of), items.bounds + 1
    least = (begin - items.sizes[used] + _BEFORE) // wide[used]
    count = (end + _BEFORE) // wide[used] - least + 2  # the last one stays empty
    ends = np.cumsum(count)
    base = np.zeros(len(wide), np.int64)
    base[used] = ends - count - least
    n = (begins[1:] - begins[:-1])[place]
    dense = ends[-1] <= min(8 * _BANDS, 8 * n.sum())
    # (start + 1/2) / wide is further from whole numbers than the errors of doubles.
    scale = (1.0 / wide)[item_of]
    move = (_BEFORE + 0.5 - offset_of) * scale + (base[item_of] if dense else 0)
    held, counted = None, []
    for i, j, row, entry in _flat(begins[place], n):
        bands = at[i:j].astype(np.float64)[row]
        bands *= scale[entry]
        bands += move[entry]
        bands = bands.astype(np.int64)
        if dense:
            more = np.bincount(bands, minlength=ends[-1])
            held = more if held is None else held + more
        else:
            counted.append(np.unique(bands + base[item_of][entry], return_counts=True))
    # A band counts with the one after it; where it is empty, that one counts by itself.
    if dense:
        half = np.flatnonzero(held >= np.repeat((items.pieces[1][used] + 1) // 2, count))
        bands = np.union1d(half, half - 1)
        bands = bands[held[bands] > 0]
        both = held[bands] + held[np.minimum(bands + 1, len(held) - 1)]
    else:
        bands, back = np.unique(np.concatenate([x for x, _ in counted]), return_inverse=True)
        found = np.bincount(back, np.concatenate([x for _, x in counted]))
        both = found + np.where(np.append(bands[1:] == bands[:-1] + 1, False), np.append(found[1:], 0), 0)
    item = used[np.searchsorted(ends, bands, "right")]
    enough = both >= items.pieces[1][item]
    return item[enough], (bands - base[item])[enough]


def _proposals(data: np.ndarray, bounds: np.ndarray, origin: int, items: Items) -> np.ndarray:
    """Rows (text, item, last, a, b): a passage of the item may lie in a..b of the text and start up to ``last``. Starts are
    counted in bands of ``k + 1`` places from ``origin``, and two bands side by side hold all intact pieces of a passage."""
    out = [np.empty((0, 5), np.int64)]
    for gram in items.grams:
        at, place = gram[1].find(_codes(data, gram[0]))
        if not len(at):
            continue
        item, bands = _bands(items, gram, at + origin, place, origin, origin + len(data))
        most, size = items.bounds[item], items.sizes[item]
        first = bands * (most + 1) - _BEFORE - origin
        last = first + 2 * most + 1
        low = np.maximum(np.searchsorted(bounds, first - most, "right") - 1, 0)
        high = np.minimum(np.searchsorted(bounds, last + most, "right"), len(bounds) - 1)
        n = np.maximum(high - low, 0)
        which, text = np.repeat(np.arange(len(item)), n), _runs(low, n)
        fits = bounds[text + 1] - bounds[text] >= (size - most)[which]
        text, which = text[fits], which[fits]
        begin = np.maximum(bounds[text], (first - most)[which])
        end = np.minimum(bounds[text + 1], (last + size + most)[which])
        out.append(np.stack([text, item[which], last[which], begin, end], 1))
    return np.concatenate(out)


def _in_line(data: np.ndarray, items: Items, size: int, item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the ranges that hold as many pieces of ``size`` characters of their item as the bound leaves, shifted
    against each other by no more than the bound. A range with very many of them is not looked at closer."""
    strings, places, begins, need = items.cut(size)
    cover = np.zeros(len(data) + 1, np.int32)
    np.add.at(cover, a, 1)
    np.add.at(cover, np.maximum(b - size + 1, a), -1)
    inside = np.flatnonzero(np.cumsum(cover)[: max(0, len(data) - size + 1)])
    at, place = strings.find(_codes(data, size, inside))
    keys = np.append(np.sort((place << 32) | inside[at]), np.iinfo(np.int64).max)
    most, count = b - size, (begins[1:] - begins[:-1])[item]

    def of(ranges: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first key of the piece in the range, the last that one may be) of ranges and numbers of pieces."""
        return np.searchsorted(keys, piece | a[ranges]), np.where(most >= a, most, -1)[ranges] | piece

    # Ranges of one item follow each other: they are looked up piece by piece, so that look-ups are near each other.
    group = np.flatnonzero(np.append(True, item[1:] != item[:-1])[: len(item)])
    size_of = np.diff(np.append(group, len(item)))
    piece = places[_runs(begins[item[group]], count[group])] << 32
    held = np.zeros(len(item), np.int64)
    for i, j, row, ranges in _flat(np.repeat(group, count[group]), np.repeat(size_of, count[group])):
        found, end = of(ranges, piece[i:j][row])
        held += np.bincount(ranges[keys[found] <= end], minlength=len(item))
    kept = np.flatnonzero(held >= need[item])
    out = np.zeros(len(item), bool)
    for i, j, row, number in _flat(begins[item[kept]], count[kept]):
        mine = kept[i:j]
        found, end = of(mine[row], places[number] << 32)
        n = np.maximum(np.searchsorted(keys, end, "right") - found, 0)
        many = np.bincount(row, n, j - i) > 4 * count[mine]
        out[mine[many | (need[item[mine]] < 1)]] = True
        n[many[row]] = 0
        which = np.repeat(np.arange(len(n)), n)
        offset = (number - begins[item[mine]][row]) * size
        starts = np.sort((row[which] << 40) + (keys[_runs(found, n)] & 0xFFFFFFFF) - offset[which] + (1 << 32))
        own = mine[starts >> 40]
        far = np.arange(len(starts)) + np.maximum(need[item[own]], 1) - 1
        near = np.flatnonzero(far < len(starts))
        near = near[starts[far[near]] - starts[near] <= items.bounds[item[own[near]]]]
        out[own[near]] = True
    return np.flatnonzero(out)


def _ranges(data: np.ndarray, bounds: np.ndarray, items: Items) -> np.ndarray:
    """Rows (text, item, last, a, b) as of ``_proposals`` that may hold a passage, by the pieces in them."""
    out, share, i = [np.empty((0, 5), np.int64)], _BANDS / (1.0 / (items.bounds + 1)).sum(), 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + share, "right")) - 1)
        origin = int(bounds[i])
        part = data[origin : bounds[j]]
        rows = _proposals(part, bounds[i : j + 1] - origin, origin, items)
        for size in (4, 3):
            rows = rows[_in_line(part, items, size, *rows[:, [1, 3, 4]].T)]
        out.append(rows + np.array([i, 0, origin, origin, origin]))
        i = j
    return np.concatenate(out)


def hits_of_piece(data: np.ndarray, bounds: np.ndarray, items: Items) -> list[list[tuple[int, int, int, int]]]:
    """Per text: (item, start, end, edits), in bytes of the text."""
    form, edges, places = normal_form(data, bounds)
    raw = form.tobytes()
    out: list[list] = [[] for _ in range(len(bounds) - 1)]

    def place(text: int, a: int, b: int) -> tuple[int, int]:
        return int(places[a] - bounds[text]), int(places[b - 1] + 1 - bounds[text])

    def clear(text: int, at: int, end: int) -> bool:
        return (at == edges[text] or raw[at - 1] == 32) and (end == edges[text + 1] or raw[end : end + 1] == b" ")

    sure: dict[tuple[int, int], int] = {}
    ranges = _ranges(form, edges, items)
    listed = ranges.tolist()
    least = least_edits(items.texts, ranges[:, 1], [raw[a:b] for *_, a, b in listed])
    for (text, i, last, a, b), edits in zip(listed, least.tolist()):
        if edits > items.edits(i):
            continue
        pattern, most = items.texts[i], items.edits(i)
        if last < sure.get((text, i), -1) - most:
            continue  # inside a hit of the same item
        at = raw.find(pattern, a, b)
        if at >= 0:
            a, edits, end = at, 0, len(pattern)
        else:
            edits, end = best_end(pattern, raw[a:b])
            back = best_end(pattern[::-1], raw[a : a + end][::-1])[1]
            a, end = a + end - back, back
        if a < sure.get((text, i), -1) or len(pattern) < items.q and not (edits and clear(text, a, a + end)):
            continue
        sure[text, i] = a + end
        out[text].append((items.numbers[i], *place(text, a, a + end), edits))
    for i in items.short:
        pattern = items.texts[i]
        at = raw.find(pattern)
        while at >= 0:
            text = int(np.searchsorted(edges, at, "right")) - 1
            end = at + len(pattern)
            inside = end <= edges[text + 1]
            if inside and clear(text, at, end):
                out[text].append((items.numbers[i], *place(text, at, end), 0))
            at = raw.find(pattern, at + 1)
    return out


def _blocks(benchmark: DataFrame, q: int, max_edits: float, block_bytes: int) -> Iterator[Items]:
    numbers, texts, held = [], [], 0
    for number, text in benchmark.dropna().toLocalIterator():
        data = np.frombuffer(text.encode(), np.uint8)
        form = normal_form(data, np.array([0, len(data)]))[0].tobytes().strip(b" ")
        if not form:
            continue
        if numbers and held + len(form) > block_bytes:
            yield Items(numbers, texts, q, max_edits)
            numbers, texts, held = [], [], 0
        numbers.append(int(number))
        texts.append(form)
        held += len(form)
    if numbers:
        yield Items(numbers, texts, q, max_edits)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", q: int = 12, max_edits: float = 0.15, block_bytes: int = 1 << 21,
) -> DataFrame:
    """(id, hits) per document; ``hits`` has item, byte range and edits of each passage found. Items are integers.

    Items go to the tasks in blocks of ``block_bytes``; one pass over the texts for each block.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    of_hit = pa.struct([("item", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])

    def search(items: Items) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, data, bounds in pieces(batch.column(1), 4 * PIECE):
                    hits = hits_of_piece(data, bounds, shared.value)
                    held = [[dict(zip(("item", "start", "end", "edits"), h)) for h in sorted(x)] for x in hits]
                    ids = batch.column(0).slice(first, len(bounds) - 1)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(held, pa.list_(of_hit))], names=["_id", "hits"])

        return rows.mapInArrow(run, f"_id {kind}, hits {HITS}")

    found = [search(items) for items in _blocks(benchmark.select(item_col, item_text_col), q, max_edits, block_bytes)]
    if not found:
        return rows.select(F.col("_id").alias(id_col), F.array().cast(HITS).alias("hits"))
    if len(found) == 1:
        return found[0].withColumnRenamed("_id", id_col)
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    merged = every.groupBy("_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"))
    return rows.select("_id").join(merged, "_id", "left").select(
        F.col("_id").alias(id_col), F.coalesce("hits", F.array().cast(HITS)).alias("hits")
    )
