"""N-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles. Two sets are linked from a Jaccard similarity of ``percent`` / 100.

1. Equal sets become one class with one representative, in a map-side combined aggregation.
2. Any two linked sets share one of the first ``n - ceil(percent * n / 100) + 1`` shingles in hash order, so the
   representatives are routed into buckets by those shingles. Who is alone in all buckets has no link. The others are
   routed again, with shingles found frequent at the end of the order, which keeps common passages out of the buckets.
3. Each bucket's members are compared with two members of it, which joins large groups of near copies into components
   without listing their pairs.
4. What is still apart within a bucket (buckets of one smallest member are one) goes through a signature tree: leaves of similar sizes, whose nodes hold the
   OR of the token bitmaps and the range of sizes. A dual traversal from the top prunes node pairs by the largest
   overlap they could have, and those that are one component already; inside two leaves it goes on to single sets.
5. Whatever a bound lets pass is verified on the whole sets. Components are found by star contraction.

Nulls and empty texts have no shingles and stand alone. A text of fewer words than a shingle is one shingle. Equal rows
share a class; a repeated id is one document per row, with its own component. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.components import components
from roadspeed.llm.texts import map_texts, mix, prefix_hash, range_hash, shingle_hashes, word_ranges
from roadspeed.session import materialise

MAP_WORDS = 8  # 64-bit words of a token bitmap
LEAF, FAN = 256, 16
_QUARTER, _LOW = np.uint64(1 << 62), 1 << 38  # of the hashes, and of their upper 40 bits
MAP = [f"b{i}" for i in range(MAP_WORDS)]
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z are folded."""
    data = _FOLD[data]
    starts, ends, first = word_ranges(data, bounds)
    words = range_hash(prefix_hash(data), starts, ends)
    every = shingle_hashes(words, width)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield mix(shingle_hashes(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _least(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The upper 40 bits of all hashes in the lowest quarter, or of so many as route the set."""
    n = max(int(np.searchsorted(tokens, _QUARTER)), prefix_length(len(tokens), percent))
    return tokens[:n] >> np.uint64(24)


def _wide_map(tokens: np.ndarray) -> bytes:
    """A bitmap with one to two bits for a token; half of its length folds it to the next smaller size."""
    size = max(512, 1 << int(len(tokens)).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[((tokens >> np.uint64(20)) % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def sketch(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(_id, n, wide, f1, f2, prefix, b0..): size, fingerprint, routing shingles and bitmaps of each document's set."""

    def run(data: np.ndarray, bounds: np.ndarray) -> list:
        sets = list(shingle_sets(data, bounds, width))
        one = np.array([np.add.reduce(mix(s)) for s in sets], np.uint64)
        two = np.array([np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) for s in sets], np.uint64)
        maps = np.zeros((len(sets), MAP_WORDS), np.uint64)
        for row, s in zip(maps, sets):
            bits = np.zeros(64 * MAP_WORDS, np.uint8)
            bits[(s >> np.uint64(20)) % np.uint64(64 * MAP_WORDS)] = 1
            row[:] = np.packbits(bits, bitorder="little").view(np.uint64)
        wide = [_wide_map(s) for s in sets]
        return [
            np.array([len(s) for s in sets], np.int64), pa.array(wide, pa.binary()), one.view(np.int64), two.view(np.int64),
            _lists([_least(s, percent) for s in sets]), *maps.T.copy().view(np.int64),
        ]

    added = "n bigint, wide binary, f1 bigint, f2 bigint, prefix array<bigint>, " + ", ".join(f"{b} bigint" for b in MAP)
    return map_texts(docs, ["_id"], "_text", run, added)


def whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """(_id, tokens): the whole set of each document."""
    return map_texts(
        docs, ["_id"], "_text", lambda data, bounds: [_lists(list(shingle_sets(data, bounds, width)))], "tokens array<bigint>"
    )


def _bits(words: list[Column]) -> Column:
    total = F.bit_count(words[0])
    for w in words[1:]:
        total = total + F.bit_count(w)
    return total


def _similar_size(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def _of(table: DataFrame, key: str, side: str) -> DataFrame:
    """The table with its columns renamed for one side of a pair."""
    return table.select(F.col(key).alias(side), *(F.col(c).alias(f"{side}_{c}") for c in table.columns if c != key))


def _words(bitmap: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(bitmap.as_buffer(), np.uint64)


def _may_link(x: np.ndarray, y: np.ndarray, n: int, m: int, percent: int) -> bool:
    """Whether two sets of n and m shingles can be linked, by the bitmaps that grow with them."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(w.reshape(-1, size), axis=0) for w in (x, y))
    most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
    return (100 + percent) * most >= percent * (n + m)


def close_pairs(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """(a, b, need) of the pairs of ids whose bitmaps allow a link: the short ones, then those that grow with the set.

    A bit that only one of two bitmaps has stands for a shingle that the other set lacks.
    """
    small = maps.drop("wide")
    pairs = pairs.join(_of(small, "rep", "a"), "a").join(_of(small, "rep", "b"), "b")
    missing = _bits([F.col(f"a_{m}").bitwiseAND(F.bitwise_not(F.col(f"b_{m}"))) for m in MAP])
    extra = _bits([F.col(f"b_{m}").bitwiseAND(F.bitwise_not(F.col(f"a_{m}"))) for m in MAP])
    most = F.least(F.col("a_n") - missing, F.col("b_n") - extra)
    need = percent * (F.col("a_n") + F.col("b_n"))
    pairs = pairs.filter((100 + percent) * most >= need).select("a", "b", "a_n", "b_n", need.alias("need"))
    wide = maps.select("rep", "wide")
    pairs = pairs.join(_of(wide, "rep", "a"), "a").join(_of(wide, "rep", "b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [[_words(v) for v in batch.column(i)] for i in (5, 6)]
            sizes = [batch.column(i).to_pylist() for i in (2, 3)]
            keep = [_may_link(x, y, n, m, percent) for x, y, n, m in zip(*wide, *sizes)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "need"])

    rows = pairs.select("a", "b", "a_n", "b_n", "need", "a_wide", "b_wide")
    return rows.mapInArrow(run, "a bigint, b bigint, need bigint")


def verify(pairs: DataFrame, maps: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids that are linked: bitmaps first, then the whole sets of those still in question."""
    close = materialise(close_pairs(pairs, maps, percent), "close-pairs")
    asked = materialise(close.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "asked")
    sets = materialise(_some_sets(source, asked, width), "sets")
    both = close.join(_of(sets, "_id", "b"), "b").join(_of(sets, "_id", "a"), "a")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return materialise(both.filter((100 + percent) * shared >= F.col("need")).select("a", "b"), "links")


def _with_component(postings: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return postings.join(found, postings["rep"] == found["id"], "left").select(
        *postings.columns, F.coalesce("component", "rep").alias("comp")
    )


def _compare_leaves(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Dual traversal below two leaves: groups of ``FAN`` sets, then the sets."""
    count = np.array([bin(i).count("1") for i in range(256)], np.uint8)

    def bits(x: np.ndarray) -> np.ndarray:
        return count[np.ascontiguousarray(x).view(np.uint8)].sum(axis=-1, dtype=np.int64)

    def members(cell: pa.StructScalar) -> tuple:
        held = cell.values
        cols = [held.field(i).to_numpy(zero_copy_only=False) for i in range(3 + MAP_WORDS)]
        order = np.argsort(cols[1], kind="stable")
        maps = np.stack(cols[3:], axis=1).view(np.uint64)[order]
        wide = held.field(3 + MAP_WORDS)
        return cols[0][order], cols[1][order], cols[2][order], maps, bits(maps), [_words(wide[int(i)]) for i in order]

    def groups(side: tuple) -> tuple:
        _, n, _, maps, own, _ = side
        at = np.arange(0, len(n), FAN)
        return np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(n, at), np.maximum.reduceat(n, at), np.minimum.reduceat(own, at)

    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            left = members(batch.column(0)[i])
            right = members(batch.column(1)[i]) if len(batch.column(1)[i]) else left
            (om, on, ox, ob), (pm, pn, px, pb) = groups(left), groups(right)
            for j in range(len(on)):
                inter = bits(om[j] & pm)
                most = np.minimum(ox[j] - np.maximum(ob[j] - inter, 0), px - np.maximum(pb - inter, 0))
                open_ = ((100 + percent) * most >= percent * (on[j] + pn)) & (100 * px >= percent * on[j]) & (100 * ox[j] >= percent * pn)
                if not open_.any():
                    continue
                mine = slice(j * FAN, (j + 1) * FAN)
                theirs = np.flatnonzero(np.repeat(open_, FAN)[: len(right[0])])
                a, b = (x[mine][:, None] for x in left[:2]), (x[theirs][None, :] for x in right[:2])
                (ia, na), (ib, nb) = tuple(a), tuple(b)
                inter = bits(left[3][mine][:, None, :] & right[3][theirs][None, :, :])
                most = np.minimum(na - left[4][mine][:, None] + inter, nb - right[4][theirs][None, :] + inter)
                ok = ((100 + percent) * most >= percent * (na + nb)) & (left[2][mine][:, None] != right[2][theirs][None, :]) & (ia != ib)
                x, y = np.nonzero(ok)
                fits = [
                    _may_link(left[5][j * FAN + p], right[5][theirs[q]], int(na[p, 0]), int(nb[0, q]), percent)
                    for p, q in zip(x.tolist(), y.tolist())
                ]
                x, y = x[fits], y[fits]
                u, v = ia[x, 0], ib[0, y]
                found.append(np.stack([np.minimum(u, v), np.maximum(u, v)]))
        both = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def tree_candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from different components that the trees of their buckets can't rule out.

    ``members`` has token, rep, n, comp and the bitmaps of every set in every bucket.
    """
    band = F.floor(F.log(F.col("n")) / math.log(100 / percent)).cast("int")
    placed = members.withColumn("band", band)
    sizes = placed.groupBy("token", "band").agg(F.ceil(F.count("*") / LEAF).alias("leaves"))
    slot = F.pmod(F.xxhash64("rep", "token"), F.col("leaves")).cast("int")
    placed = placed.join(sizes, ["token", "band"]).withColumn("slot", slot).withColumn("own", _bits([F.col(b) for b in MAP]))
    node = [
        *(F.bit_or(b).alias(b) for b in MAP), F.min("least").alias("least"), F.max("most").alias("most"),
        F.min("own").alias("own"), F.min("c0").alias("c0"), F.max("c1").alias("c1"),
    ]
    ranged = placed.select(
        "token", "band", "slot", "own", *MAP, F.col("n").alias("least"), F.col("n").alias("most"), F.col("comp").alias("c0"),
        F.col("comp").alias("c1"), F.struct("rep", "n", "comp", *MAP, "wide").alias("doc"),
    )
    leaves = materialise(ranged.groupBy("token", "band", "slot").agg(*node, F.collect_list("doc").alias("docs")), "leaves")
    tops = leaves.withColumn("slot", F.floor(F.col("slot") / FAN).cast("int")).groupBy("token", "band", "slot").agg(*node)

    def side(nodes: DataFrame, name: str, extra: list[str]) -> DataFrame:
        return nodes.select("token", *(F.col(c).alias(f"{name}_{c}") for c in ["band", "slot", "least", "most", "own", "c0", "c1", *MAP, *extra]))

    def open_pairs(pairs: DataFrame) -> DataFrame:
        """Node pairs, each once, that may hold a link between two components."""
        inter = _bits([F.col(f"x_{m}").bitwiseAND(F.col(f"y_{m}")) for m in MAP])
        most = F.least(*(F.col(f"{s}_most") - F.greatest(F.col(f"{s}_own") - inter, F.lit(0)) for s in "xy"))
        apart = ~((F.col("x_c0") == F.col("x_c1")) & (F.col("y_c0") == F.col("y_c1")) & (F.col("x_c0") == F.col("y_c0")))
        once = (F.col("x_band") < F.col("y_band")) | ((F.col("x_band") == F.col("y_band")) & (F.col("x_slot") <= F.col("y_slot")))
        near = (F.col("y_band") - F.col("x_band")).between(0, 1)
        return pairs.filter(once & near & apart & ((100 + percent) * most >= percent * (F.col("x_least") + F.col("y_least"))))

    upper = open_pairs(side(tops, "x", []).join(side(tops, "y", []), "token"))
    upper = upper.select("token", "x_band", "y_band", F.col("x_slot").alias("x_top"), F.col("y_slot").alias("y_top"))
    lower = leaves.drop("docs").withColumn("top", F.floor(F.col("slot") / FAN).cast("int"))
    pairs = upper.join(side(lower, "x", ["top"]), ["token", "x_band", "x_top"])
    pairs = open_pairs(pairs.join(side(lower, "y", ["top"]), ["token", "y_band", "y_top"]))
    pairs = materialise(pairs.select("token", "x_band", "x_slot", "y_band", "y_slot"), "leaf-pairs")

    def held(name: str) -> DataFrame:
        return leaves.select("token", *(F.col(c).alias(f"{name}_{c}") for c in ("band", "slot", "docs")))

    pairs = pairs.join(held("x"), ["token", "x_band", "x_slot"])
    alone = (F.col("x_band") == F.col("y_band")) & (F.col("x_slot") == F.col("y_slot"))
    two = pairs.filter(~alone).join(held("y"), ["token", "y_band", "y_slot"]).select("x_docs", "y_docs")
    one = pairs.filter(alone).select("x_docs", F.slice("x_docs", 1, 0).alias("y_docs"))  # the same leaf twice
    return one.union(two).mapInArrow(lambda it: _compare_leaves(it, percent), "a bigint, b bigint").distinct()


def _routed(classes: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(token, rep, n): the shingles that route each set, in the order: the lowest quarter of the hashes without the
    frequent ones, the frequent ones, the other hashes."""
    shared = classes.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for i, n in enumerate(batch.column(1).to_pylist()):
                tokens = batch.column(2)[i].values.to_numpy()
                at = np.minimum(np.searchsorted(shared.value, tokens), max(len(shared.value) - 1, 0))
                hot = shared.value[at] == tokens if len(shared.value) else np.zeros(len(tokens), bool)
                low = tokens < _LOW
                first = np.concatenate([tokens[low & ~hot], tokens[low & hot], tokens[~low]])
                heads.append(first[: prefix_length(n, percent)].view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(heads)], names=["rep", "n", "prefix"])

    out = classes.select("rep", "n", "prefix").mapInArrow(run, "rep bigint, n bigint, prefix array<bigint>")
    return out.select(F.explode("prefix").alias("token"), "rep", "n")


def _frequent(sizes: DataFrame, size: int, most: int) -> np.ndarray:
    rows = sizes.filter((F.col("size") > size) & (F.col("token") < _LOW)).orderBy(F.desc("size"), "token").limit(most)
    return np.sort(rows.select("token").toPandas()["token"].to_numpy(np.int64))


def _filter_of(ids: DataFrame, name: str, bits: int = 1 << 25) -> np.ndarray:
    """Bit array of ``bits`` bits, one set for each id: a filter of fixed size that lets some others pass."""
    place = F.pmod(F.xxhash64(name), F.lit(bits))
    words = ids.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64({name}), {bits}) & 63 as int))")).alias("bits")
    )
    rows = words.toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _some_sets(source: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(_id, tokens) for the given ids. A filter of fixed size drops most other texts before anything is shuffled."""
    bits = source.sparkSession.sparkContext.broadcast(_filter_of(ids, "_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).to_numpy()
            hit = (bits.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            if hit.any():
                yield batch.filter(pa.array(hit.astype(bool))).select(["_id", "_text"])

    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 25))
    marked = source.select("_id", place.alias("_place"), "_text").mapInArrow(
        lambda it: run(b.select(["_id", "_place", "_text"]) for b in it), "_id bigint, _text string"
    )
    return whole_sets(marked, width).join(ids, "_id", "left_semi")


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85,
    common: int = 64, most_common: int = 200_000,
) -> DataFrame:
    """(id, n_shingles, component_id): ``component_id`` is the smallest id reachable by links. Ids are integers.

    Shingles in more than ``common`` prefixes, the most frequent ``most_common`` of them, only change the order that
    routes; the result is the same without them.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    sketches = materialise(sketch(source, width, percent), "sketches")
    key = ["n", "f1", "f2"]
    classes = sketches.filter("n > 0").groupBy(*key).agg(
        F.min("_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("wide").alias("wide"), *(F.first(b).alias(b) for b in MAP)
    )
    classes = materialise(classes, "classes")
    sizes = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("size"))
    sizes = materialise(sizes.filter("size > 1"), "token-sizes")
    frequent = _frequent(sizes, common, most_common)
    routed = materialise(_routed(classes, frequent, percent).join(sizes.select("token"), "token"), "routed")
    first, other = F.min(F.struct("rep", "n")), F.min_by(F.struct("rep", "n"), F.xxhash64("rep", "token"))
    shared = routed.groupBy("token").agg(F.count("*").alias("size"), F.array(first, other).alias("heads"))
    buckets = materialise(routed.join(shared.filter("size > 1"), "token"), "buckets")
    involved = buckets.select(F.col("rep").alias("_id")).distinct()
    maps = classes.join(involved, classes["rep"] == involved["_id"], "left_semi").select("rep", "n", "wide", *MAP)
    maps = materialise(maps, "bitmaps")

    pairs = buckets.select("rep", "n", F.explode(F.array_distinct("heads")).alias("head")).filter("rep <> head.rep")
    pairs = pairs.filter(_similar_size("n", "head.n", percent))
    pairs = pairs.select(F.least("rep", "head.rep").alias("a"), F.greatest("rep", "head.rep").alias("b")).distinct()
    links = verify(pairs, maps, source, width, percent)

    known = materialise(_with_component(buckets.select("token", "rep", "n"), links), "postings")
    # Buckets with one smallest member overlap widely, so they become one bucket and a pair is met once in it.
    open_ = known.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("rep").alias("head"))
    open_ = open_.filter("c0 < c1").select("token", "head")
    members = known.join(open_, "token").groupBy(F.col("head").alias("token"), "rep").agg(F.first("comp").alias("comp"))
    members = members.join(maps, "rep")
    rest = tree_candidates(members, percent)
    links = links.union(verify(rest, maps, source, width, percent))

    found = components(links)
    classes = classes.select("rep", *key)
    classes = classes.join(found, classes["rep"] == found["id"], "left").select(*key, F.coalesce("component", "rep").alias("component"))
    return sketches.select("_id", *key).join(classes, key, "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("component_id")
    )
