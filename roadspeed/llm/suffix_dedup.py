"""Removal of repeated byte strings, by refinement of q-gram buckets.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else. Sorting all suffixes of a corpus
is out of reach, so the buckets start from anchors: the q-gram of least hash in each window of ``length`` bytes. Equal
windows have equal anchors at equal offsets, so every window belongs to one anchor, and there is one anchor for some
hundred bytes.

* Initial buckets are the anchors' q-grams. In a bucket the *hull* of an anchor, all bytes of the windows it owns,
  gives it a class; classes of two or more are covered whole.
* Buckets with more than one class are refined: the offsets of the windows are split, and the members get new bucket
  identifiers from the string common to all windows of a part (its *core*) and new classes from its hull. A part whose
  core is alone is unique; a part whose hull repeats is covered. What is undecided is refined with the same step, down
  to single windows. Of each class one member goes on, so a passage copied any number of times costs one.

Null is empty. Matches don't cross texts, and texts shorter than ``length`` lose nothing. Ids are unique; an equal row
repeats its text, which then goes as a whole. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.texts import map_texts, pieces, prefix_hash, range_hash
from roadspeed.session import materialise

_LOW = np.uint64(0xFFFFFFFF)
ANCHOR = "array<struct<pos:int,o0:int,o1:int,gram:bigint,hull:bigint>>"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive entries."""
    out, held = x, 1
    while held * 2 <= width:
        out = np.minimum(out[:-held], out[held:])
        held *= 2
    rest = width - held
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors_of_piece(data: np.ndarray, bounds: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    """(text, pos, o0, o1, gram, hull) of each anchor: its place in the text, the offsets of the windows it owns
    (a window starts ``o`` bytes before it), and the hashes of its q-gram and of its hull."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    at = np.arange(len(data) - q + 1)
    grams = range_hash(prefix_hash(data), at, at + q)
    least = _sliding_min((grams & ~_LOW) | at.astype(np.uint64), length - q + 1)
    size = np.diff(bounds)
    start = np.flatnonzero(np.repeat(bounds[1:], size)[: len(least)] - np.arange(len(least)) >= length)
    anchor = (least[start] & _LOW).astype(np.int64)
    if not len(anchor):
        return tuple(np.empty(0, np.int64) for _ in range(6))
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    pos, s0, s1 = anchor[new], start[new], start[np.append(new[1:], len(start)) - 1]
    view = memoryview(np.ascontiguousarray(data))
    hulls = b"".join(
        hashlib.blake2b(view[a:b], digest_size=8).digest() for a, b in zip(s0.tolist(), (s1 + length).tolist())
    )
    text = np.searchsorted(bounds, pos, "right") - 1
    return text, pos - bounds[text], pos - s1, pos - s0, grams[pos].view(np.int64), np.frombuffer(hulls, np.int64)


def anchors(docs: DataFrame, length: int, q: int) -> DataFrame:
    """(_id, pos, o0, o1, gram, hull) of every anchor of every whole text."""

    def run(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        text, *rest = anchors_of_piece(data, bounds, length, q)
        offsets = np.searchsorted(text, np.arange(len(bounds))).astype(np.int32)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        held = pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(rest, kinds)], ["pos", "o0", "o1", "gram", "hull"])
        return [pa.ListArray.from_arrays(pa.array(offsets), held)]

    return map_texts(docs, ["_id"], "_text", run, f"anchors {ANCHOR}").select("_id", F.inline("anchors"))


def _contexts(docs: DataFrame, live: DataFrame, length: int) -> DataFrame:
    """(_id, pos, o0, o1, known, context): the hull's bytes of each undecided anchor."""
    by_text = live.groupBy("_id").agg(F.collect_list(F.struct("pos", "o0", "o1", "known")).alias("held"))
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in pieces(batch.column(1)):
                held = batch.column(2).slice(first, len(bounds) - 1)
                text = np.repeat(np.arange(len(bounds) - 1), held.value_lengths().to_numpy())
                flat = held.flatten()
                pos, o0, o1 = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
                raw = data.tobytes()
                a, b = bounds[text] + pos - o1, bounds[text] + pos - o0 + length
                for i in range(0, len(pos), 20_000):
                    part = slice(i, i + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(bounds) - 1).take(pa.array(text[part])),
                            *(flat.field(j).slice(i, 20_000) for j in range(4)),
                            pa.array([raw[x:y] for x, y in zip(a[part].tolist(), b[part].tolist())], pa.binary()),
                        ],
                        names=["_id", "pos", "o0", "o1", "known", "context"],
                    )

    rows = docs.join(by_text, "_id").select("_id", "_text", "held")
    return rows.mapInArrow(run, f"_id {kind}, pos int, o0 int, o1 int, known boolean, context binary")


def _widths(offsets: int, parts: int = 8) -> list[int]:
    out = [offsets]
    while out[-1] > 1:
        out.append(-(-out[-1] // parts))
    return out


def repeated_spans(docs: DataFrame, length: int, q: int) -> DataFrame:
    """(_id, a, b): byte ranges that cover exactly the repeated strings; they may overlap."""
    every = materialise(anchors(docs, length, q), "anchors")
    key = ["gram", "o0", "o1", "hull"]
    classes = every.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("_id", "pos")).alias("rep"))
    classes = materialise(classes.join(classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).filter("all > 1"), "gram"), "classes")
    found = every.join(classes.filter("n > 1").select(*key), key)
    spans = found.select("_id", (F.col("pos") - F.col("o1")).alias("a"), (F.col("pos") - F.col("o0") + length).alias("b"))
    spans = [materialise(spans, "spans")]
    live = classes.filter("kinds > 1").select("rep._id", "rep.pos", "o0", "o1", (F.col("n") > 1).alias("known"))
    live = materialise(_contexts(docs, live, length), "contexts").withColumn("lo", F.lit(0))

    widths = _widths(length - q + 1)
    for wide, narrow in zip(widths, widths[1:]):
        part = F.explode(F.expr(f"sequence(lo, lo + {wide - 1}, {narrow})")).alias("o")
        split = live.select("_id", "pos", "o0", "o1", "known", "context", part)
        split = split.filter(f"o <= o1 AND o + {narrow - 1} >= o0").selectExpr(
            "*", "greatest(o, o0) AS p0", f"least(o + {narrow - 1}, o1) AS p1"
        )
        split = materialise(split.selectExpr(
            "_id", "pos", "o0", "o1", "known", "o", "p0", "p1", "context",
            f"xxhash64(substring(context, o1 - o + 1, {length - narrow + 1})) AS core",
            f"xxhash64(substring(context, o1 - p1 + 1, {length} + p1 - p0)) AS hull",
        ), "parts")
        key = ["o", "core", "p0", "p1", "hull"]
        narrow_rows = split.drop("context")
        classes = narrow_rows.groupBy(*key).agg(
            F.count("*").alias("n"), F.max("known").alias("seen"), F.min(F.struct("_id", "pos")).alias("rep")
        )
        kinds = classes.groupBy("o", "core").agg(F.count("*").alias("kinds"))
        classes = classes.join(kinds, ["o", "core"]).withColumn("again", F.col("seen") | (F.col("n") > 1))
        classes = materialise(classes.filter("again OR kinds > 1"), "classes")
        found = narrow_rows.filter(~F.col("known")).join(classes.filter("again").select(*key), key)
        found = found.select("_id", (F.col("pos") - F.col("p1")).alias("a"), (F.col("pos") - F.col("p0") + length).alias("b"))
        spans.append(materialise(found, "spans"))
        if narrow > 1:
            go_on = classes.filter("kinds > 1").select("rep._id", "rep.pos", "o", F.col("again").alias("known"))
            kept = split.drop("known").join(go_on, ["_id", "pos", "o"]).select("_id", "pos", "o0", "o1", "known", "context", F.col("o").alias("lo"))
            live = kept
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, q: int = 32
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) per document; ``kept`` is what remains, as bytes."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    spans = repeated_spans(source, length, q)
    by_text = spans.groupBy("_id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in pieces(batch.column(1)):
                n = len(bounds) - 1
                held = batch.column(2).slice(first, n)
                sizes = np.nan_to_num(held.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = held.flatten()
                base = np.repeat(bounds[:-1], sizes)
                cover = np.zeros(len(data) + 1, np.int32)
                np.add.at(cover, flat.field(0).to_numpy().astype(np.int64) + base, 1)
                np.add.at(cover, flat.field(1).to_numpy().astype(np.int64) + base, -1)
                gone = np.cumsum(cover[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                edge = bounds[:-1][np.diff(bounds) > 0]
                opens[edge] = gone[edge]
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]).astype(np.int64)
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n), pa.array(np.diff(bounds).astype(np.int64)), pa.array(total(gone)),
                        pa.array(total(opens)), pa.array(kept, pa.binary()),
                    ],
                    names=["_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    joined = source.join(by_text, "_id", "left").select("_id", "_text", "spans")
    out = joined.mapInArrow(run, f"_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.withColumnRenamed("_id", id_col)
