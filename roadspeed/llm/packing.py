"""Best-fit packing of tokenised documents into sequences of fixed length.

A document is its token ids and a closing id. Only documents that don't fit one sequence are cut, into pieces of the full
length and a rest. Pieces are packed by bulk-synchronous best fit; each round

1. opens new sequences for pieces that no gap can hold: one for each of more than half a sequence, and for the others
   half of what their tokens need (all of it where that is a few hundredths of the sequences, or where pieces are small);
2. cuts gaps of twice the longest piece or more into slots that each hold any piece;
3. orders pieces and slots by falling size, slots first. The order is dealt out by size, large sizes in buckets;
   counts by size give each row its rank, so no task sorts more than a bucket;
4. sweeps the order: a piece takes the smallest slot before it that is still free. This is the matching of brackets: a slot
   opens a level and a piece closes the last open one, so ranks give the level, and at each level the next row is the partner.
   Pieces for which no level is open have lost to others and wait for the next round;
5. makes each sequence's gap the sum of what is left in its slots.

The driver sees counts by size only, at most twice the sequence length of numbers. At least the longest pieces are placed in
each round. Ties between pieces of one length are broken by bucket and row, which changes no count.

A null text is empty and is its closing id alone. Each row is packed, repeated rows and ids included. An empty table gives no
rows. Very long texts become many pieces. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspeed.llm.texts import pieces as text_pieces
from roadspeed.session import materialise

_CLOSE = b" "  # no word: the closing id's place in the table of words
_GAP, _PIECE = 0, 1
_TASK_ROWS = 1 << 15  # pieces or slots that a task of a round handles


# How the tokenizer cuts a word of printable ASCII characters in lower case.
_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_ASCII = re.compile(rb"[!-~]+")
_GROUP = 200  # other words that are encoded as one text


class _Numbers(dict):
    """Numbers words in the order in which they are first looked up; ``new`` lists those that were."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordIds:
    """Token ids of texts, word by word, with the ids of about ``most`` words kept.

    For the tokenizers' BPE with word ends that drops white space: no token reaches across it, so a text's ids are those of
    its words one after the other. Words of printable ASCII characters are cut here and their parts go to the tokenizer's
    model, which most words share; all others go through the whole tokenizer.
    """

    def __init__(self, tokenizer: str, close_id: int, most: int = 1 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel units
        from tokenizers import Tokenizer

        self.tokenizer, self.close_id, self.most = Tokenizer.from_str(tokenizer), close_id, most
        self.model = self.tokenizer.model
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0
        self.first, self.size, self.n_words = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32), 0
        self._add([[self.close_id]])
        self.numbers[_CLOSE] = 0

    def _add(self, lists: list[Sequence[int]]) -> None:
        """Ids of the next words by number."""
        sizes = np.fromiter(map(len, lists), np.int32, len(lists))
        total, last = int(sizes.sum()), self.n_words + len(lists)
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while last > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        self.ids[self.n_ids : self.n_ids + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        self.first[self.n_words : last] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[self.n_words : last] = sizes
        self.n_ids, self.n_words = self.n_ids + total, last

    def _part(self, part: bytes) -> tuple[int, ...]:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = tuple([token.id for token in self.model.tokenize(part.decode())])
        return ids

    def _plain(self, word: bytes) -> tuple[int, ...]:
        word = word.lower()
        if word.isalpha():
            return self._part(word)
        return tuple(chain.from_iterable(map(self._part, _PARTS.findall(word))))

    def _others(self, words: list[bytes]) -> Iterator[list[int]]:
        texts = [word.decode() for word in words]
        groups = [texts[i : i + _GROUP] for i in range(0, len(texts), _GROUP)]
        coded = self.tokenizer.encode_batch([" ".join(group) for group in groups], add_special_tokens=False)
        for group, text in zip(groups, coded):
            sizes = np.fromiter(map(len, group), np.int64, len(group)) + 1
            ids = text.ids
            begins = np.fromiter((begin for begin, _ in text.offsets), np.int64, len(ids))
            cuts = np.searchsorted(begins, np.cumsum(sizes)).tolist()
            yield from (ids[a:b] for a, b in zip([0, *cuts], cuts))

    def _learn(self) -> None:
        """The ids of the words that were numbered since."""
        new, self.numbers.new = self.numbers.new, []
        plain = [_ASCII.fullmatch(w) is not None and b"<|" not in w for w in new]  # special tokens begin with these
        others = self._others([w for w, simple in zip(new, plain) if not simple])
        self._add([self._plain(w) if simple else next(others) for w, simple in zip(new, plain)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with the closing id; where each text ends)."""
        if self.n_words > self.most:
            self._clear()
        words = [text.split() for text in texts]  # at ASCII white space
        for own in words:
            own.append(_CLOSE)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        places = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int32, counts.sum())
        self._learn()
        sizes = self.size[places]
        ends = np.cumsum(sizes, dtype=np.int64)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(self.first[places] - ends + sizes, sizes)
        return self.ids[at], ends[np.cumsum(counts) - 1]


_LOADED: dict[tuple[int, int], WordIds] = {}


def _loaded(tokenizer: str, close_id: int) -> WordIds:
    """The tokenizer of this Python worker, kept between its tasks."""
    key = (zlib.crc32(tokenizer.encode()), close_id)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordIds(tokenizer, close_id)
    return _LOADED[key]


def token_pieces(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    close_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) per piece; with ``keep_ids`` also ``ids``, little-endian 32-bit numbers.

    ``tokenizer_file`` is a file of the tokenizers library, read by the driver; its text, whose size is that of the
    vocabulary, goes to the tasks.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    with open(tokenizer_file, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(sent.value, close_id)
        for batch in batches:
            for first, data, bounds in text_pieces(batch.column(1)):
                raw = data.tobytes()
                ids, ends = coder.encode([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])])
                sizes = np.diff(ends, prepend=0)
                n_pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                at = (ends - sizes)[doc] + start
                stored = memoryview(ids.astype("<u4").tobytes())
                parts = [stored[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
                columns = [batch.column(0).take(pa.array(first + doc)), pa.array(piece), pa.array(start), pa.array(length)]
                columns.append(pa.array([zlib.crc32(x) for x in parts], pa.int64()))
                if keep_ids:
                    columns.append(pa.array([bytes(x) for x in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = source.schema["_id"].dataType.simpleString()
    added = "piece bigint, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return source.mapInArrow(run, f"`{id_col}` {kind}, {added}")


def _to_open(waiting: np.ndarray, rooms: np.ndarray, opened: int) -> int:
    """New sequences, beside ``opened``, for the pieces longer than any gap. Both arrays count by size."""
    capacity = len(rooms) - 1
    largest = max(np.flatnonzero(rooms), default=0)
    sizes = np.arange(capacity + 1)
    must = np.where(sizes > largest, waiting, 0)
    whole = -(-int((must * sizes).sum()) // capacity)
    halves = int(must[capacity // 2 + 1 :].sum())
    longest = int(max(np.flatnonzero(waiting)))
    if whole > 0.03 * opened and 16 * longest > capacity:
        whole = -(-whole // 2)
    return max(whole, halves)


def _order(waiting: np.ndarray, slots: np.ndarray, bucket: int) -> list[tuple[int, int, int, int, int]]:
    """(kind, size, buckets, base, step) for each size that occurs: row r of a size has level base + step * r."""
    depth, out = 0, []
    for size in range(len(slots) - 1, -1, -1):
        if slots[size]:
            out.append((_GAP, size, -(-int(slots[size]) // bucket), depth + 1, 1))
            depth += int(slots[size])
        if waiting[size]:
            out.append((_PIECE, size, -(-int(waiting[size]) // bucket), depth, -1))
            depth = max(0, depth - int(waiting[size]))
    return out


def _sized(rows: DataFrame, n: int) -> DataFrame:
    """As many tasks as ``n`` rows are worth, however many partitions a shuffle has."""
    return rows.coalesce(max(1, -(-n // _TASK_ROWS)))


def _counts(rows: DataFrame, sizes: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces and gaps by size, a bounded number of rows."""
    out = np.zeros((2, sizes), np.int64)
    by_size = rows.groupBy("kind", "size").count()
    for kind, size, n in _sized(by_size, 2 * sizes).collect():
        out[kind, size] = n
    return out[_PIECE], out[_GAP]


def _ranked(rows: DataFrame, order: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The rows with their level in the sweep."""
    known = rows.sparkSession.createDataFrame(order, "kind int, size int, buckets int, base bigint, step int")
    rows = rows.join(F.broadcast(known), ["kind", "size"])  # at most twice the sequence length of rows
    if all(buckets == 1 for _, _, buckets, _, _ in order):
        rank = F.row_number().over(Window.partitionBy("kind", "size").orderBy("key", "slot")) - 1
        return rows.select("kind", "size", "key", "slot", (F.col("base") + F.col("step") * rank).alias("level"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "slot"), F.col("buckets")))
    by = ["kind", "size", "bucket"]
    earlier = Window.partitionBy("kind", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*by).count().select(*by, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("key", "slot")) - 1
    level = F.col("base") + F.col("step") * (F.col("before") + F.col("rank"))
    return rows.withColumn("rank", rank).join(before, by).select("kind", "size", "key", "slot", level.alias("level"))


def best_fit(pieces: DataFrame, key: str, length: str = "length", capacity: int = 2048, bucket: int = 4096) -> DataFrame:
    """(key, sequence_id): where each piece goes. ``key`` is a unique number and lengths are from 1 to ``capacity``."""
    spark = pieces.sparkSession
    waiting = pieces.select(F.col(key).alias("key"), F.col(length).cast("int").alias("size"))
    rooms, opened, placed = None, 0, []
    as_piece = [F.lit(_PIECE).alias("kind"), "size", "key", F.lit(0).alias("slot")]
    as_gap = [F.lit(_GAP).alias("kind"), "size", "key", F.lit(0).alias("slot")]
    while True:
        state = waiting.select(*as_piece)
        pieces_by, rooms_by = _counts(state.union(rooms.select(*as_gap)) if rooms else state, capacity + 1)
        if not pieces_by.any():
            break
        sizes = np.flatnonzero(pieces_by)
        shortest, longest = int(sizes[0]), int(sizes[-1])
        rooms_by[:shortest] = 0
        new = _to_open(pieces_by, rooms_by, opened)
        rooms_by[capacity] += new
        fresh = spark.range(opened, opened + new).select(F.col("id").alias("key"), F.lit(capacity).alias("size"))
        opened += new
        gaps = (rooms.filter(F.col("size") >= shortest).unionByName(fresh) if rooms else fresh).select("key", "size")

        # The first slot of a gap takes what the others leave.
        n_slots = F.greatest(F.floor(F.col("size") / longest), F.lit(1)).cast("int")
        slots = gaps.select("key", "size", n_slots.alias("n"), F.explode(F.sequence(F.lit(0), n_slots - 1)).alias("slot"))
        room = F.when(F.col("slot") == 0, F.col("size") - (F.col("n") - 1) * longest).otherwise(longest)
        slots = slots.select(F.lit(_GAP).alias("kind"), room.alias("size"), "key", "slot")
        slots_by = np.zeros(capacity + 1, np.int64)
        for size in np.flatnonzero(rooms_by).tolist():
            n = max(1, size // longest)
            slots_by[size - (n - 1) * longest] += rooms_by[size]
            slots_by[longest] += (n - 1) * rooms_by[size]

        rows = int(pieces_by.sum() + slots_by.sum())
        ranked = _ranked(state.union(slots), _order(pieces_by, slots_by, bucket))
        ranked = materialise(_sized(ranked, rows), "pack-ranked")
        after = Window.partitionBy("level").orderBy(F.desc("size"), "kind")
        partner = F.when(F.lead("kind").over(after) == _PIECE, F.struct(F.lead("key").over(after), F.lead("size").over(after)))
        swept = ranked.filter("level > 0").withColumn("partner", partner.cast("struct<key:bigint,size:int>"))
        swept = swept.filter(F.col("kind") == _GAP).select("key", "size", "partner")
        swept = materialise(_sized(swept, rows), "pack-swept")
        placed.append(swept.filter("partner IS NOT NULL").select(F.col("partner.key").alias(key), F.col("key").alias("sequence_id")))
        left = F.sum(F.col("size") - F.coalesce("partner.size", F.lit(0))).cast("int")
        rooms = swept.groupBy("key").agg(left.alias("size"))
        rooms = materialise(_sized(rooms, int(slots_by.sum())), "pack-rooms")
        waiting = ranked.filter((F.col("kind") == _PIECE) & (F.col("level") <= 0)).select("key", "size")
    if not placed:
        return spark.createDataFrame([], f"`{key}` bigint, sequence_id bigint")
    return reduce(DataFrame.unionAll, placed)


def pack(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    close_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece; with ``keep_ids`` also ``ids``."""
    if capacity < 1:
        raise ValueError("capacity starts at 1")
    cut = token_pieces(docs, tokenizer_file, id_col, text_col, capacity, close_id, keep_ids)
    cut = materialise(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = cut.join(best_fit(cut, "_row", "length", capacity), "_row")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return placed.select(*[c for c in cut.columns if c != "_row"], "sequence_id", offset)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of rows packed with ``keep_ids``: the ids of a sequence as one binary."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
