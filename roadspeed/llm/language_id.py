"""Language identification with interpolated Kneser-Ney character models.

Four-character sequences are counted by Spark over all training texts, and all of them stay in the models. Each language
gets an interpolated Kneser-Ney model of order four, with continuation counts below (a key is four UTF-16 units, so it is
a hash without collisions). The models are made by Spark as one table of terms: the log probability of a character is the
sum of the terms of its keys and contexts, where a missing term is 0. So terms go to the tasks in blocks of bounded size,
each block against all texts, and the sums of the blocks are added. A text gets the language of lowest cross-entropy per
character; the language's own training texts calibrate from which cross-entropy on a text is rejected.

Null text, empty text and text without a letter is ``und`` with score 0. Null languages and null texts are not learned
from. If nothing can be learned, all is ``und``. Ties go to the language that sorts first. Case is folded, and whatever
is no letter counts as a space.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.texts import pieces
from roadspeed.session import materialise

ORDER = 4
UNKNOWN = "und"
_HALF = 0xFFFD  # stands for half of a character beyond 16 bits
_HELD = 1 << 21  # grams a task holds per language before it merges them
_STEP = 1 << 14  # keys whose terms are added at a time


@cache
def _folded() -> np.ndarray:
    """For each UTF-16 unit its lower-case letter, or a space; ``_HALF`` for halves of rarer characters."""
    table = np.full(1 << 16, 32, np.uint16)
    for i in range(1 << 16):
        low = chr(i).lower()
        if chr(i).isalpha():
            table[i] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else i
    table[0xD800:0xE000] = _HALF
    return table


def grams_of_piece(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed four-character keys, first key of each text and the end, whether a text has a letter)."""
    units = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-16-le"), np.uint16)
    per_byte = ((data & 0xC0) != 0x80).astype(np.int64) + (data >= 0xF0)
    edges = np.concatenate([[0], np.cumsum(per_byte)])[bounds]
    low = _folded()[units]
    blank = low == 32
    at_edge = np.zeros(len(low) + 1, bool)
    at_edge[edges] = True
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[at_edge[:-1] & blank] = False
    letters = np.concatenate([[0], np.cumsum(~blank & (low != _HALF))])
    has_letter = letters[edges[1:]] > letters[edges[:-1]]
    for i in np.unique(np.searchsorted(edges, np.flatnonzero(low == _HALF), "right") - 1):
        if not has_letter[i]:  # signs such as emoji are no letters, other scripts are
            has_letter[i] = any(map(str.isalpha, data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")))
    kept = np.flatnonzero(keep)
    first = np.searchsorted(kept, edges)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    padded = np.full(len(kept) + (ORDER - 1) * (len(bounds) - 1) + ORDER, 32, np.uint64)
    place = np.arange(len(kept)) + (ORDER - 1) * (text + 1)
    padded[place] = low[kept]
    keys = padded[place]
    for back in range(1, ORDER):
        keys = keys | (padded[place - back] << np.uint64(16 * back))
    return keys, first, has_letter


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    distinct, back = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(back, counts, len(distinct)).astype(np.int64)


def count_grams(training: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all texts; a task counts what it reads before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, list] = defaultdict(list)
        fresh: dict[str, list] = defaultdict(list)

        def settle(lang: str) -> None:
            counted[lang] = [_merge([*counted[lang], np.unique(np.concatenate(fresh.pop(lang)), return_counts=True)])]

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, data, bounds in pieces(batch.column(1)):
                keys, first, _ = grams_of_piece(data, bounds)
                by_lang = defaultdict(list)
                for i in range(len(bounds) - 1):
                    by_lang[langs[start + i]].append(keys[first[i] : first[i + 1]])
                for lang, found in by_lang.items():
                    fresh[lang].append(np.concatenate(found))
                    if sum(map(len, fresh[lang])) > _HELD:
                        settle(lang)
        for lang in list(fresh):
            settle(lang)
        for lang, [(keys, counts)] in counted.items():
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(counts[i : i + 50_000])],
                    names=["lang", "gram", "n"],
                )

    rows = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Models:
    """Sorted keys of each order, log probabilities (key, language), and log back-off weights of sorted contexts."""

    langs: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    unknown: np.ndarray

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Of each gram's last character after the others, for each language."""
        out = np.zeros((len(grams), len(self.langs)))
        open_ = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            now = _suffix(grams[open_], order)
            at, hit = _find(self.keys[order - 1], now)
            out[open_[hit]] += self.logs[order - 1][at[hit]]
            open_, now = open_[~hit], now[~hit]
            if order > 1:
                at, hit = _find(self.contexts[order - 1], now >> np.uint64(16))
                out[open_[hit]] += self.backoffs[order - 1][at[hit]]
        out[open_] += self.unknown
        return out


def _suffix(grams: np.ndarray, order: int) -> np.ndarray:
    return grams & np.uint64((1 << 16 * order) - 1)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Interpolated Kneser-Ney models from the four-character counts (keys, counts) of each language, in memory.

    This is the plain method, which the tests hold the terms of ``model_terms`` against.
    """
    langs = sorted(counts)
    tables: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [{} for _ in range(ORDER)]
    for lang in langs:
        order = np.argsort(counts[lang][0])
        tables[-1][lang] = counts[lang][0][order], counts[lang][1][order].astype(float)
        for n in range(ORDER - 1, 0, -1):  # how many different characters stand before
            keys, number = np.unique(_suffix(tables[n][lang][0], n), return_counts=True)
            tables[n - 1][lang] = keys, number.astype(float)
    keys = [np.unique(np.concatenate([t[lang][0] for lang in langs])) for t in tables]
    size = len(keys[0]) + 1
    logs, contexts, backoffs = [], [], []
    lower = np.full((1, len(langs)), 1 / size)
    for n in range(1, ORDER + 1):
        context = np.unique(keys[n - 1] >> np.uint64(16)) if n > 1 else np.zeros(1, np.uint64)
        of_key = np.searchsorted(context, keys[n - 1] >> np.uint64(16)) if n > 1 else np.zeros(len(keys[0]), int)
        below = lower[np.searchsorted(keys[n - 2], _suffix(keys[n - 1], n - 1))] if n > 1 else lower
        own, weight = np.zeros((len(keys[n - 1]), len(langs))), np.ones((len(context), len(langs)))
        for j, lang in enumerate(langs):
            mine, number = tables[n - 1][lang]
            once, twice = (number == 1).sum(), (number == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            at = np.searchsorted(keys[n - 1], mine)
            total = np.bincount(of_key[at], number, len(context))
            kinds = np.bincount(of_key[at], minlength=len(context))
            seen = total > 0
            weight[seen, j] = discount * kinds[seen] / total[seen]
            own[at, j] = (number - discount) / total[of_key[at]]
        lower = own + weight[of_key] * below
        logs.append(np.log(lower).astype(np.float32))
        contexts.append(context)
        backoffs.append(np.log(weight).astype(np.float32))
        if n == 1:
            unknown = weight[0] / size
    return Models(langs, keys, logs, contexts, backoffs, np.log(unknown))


def _of_lang(values: list[float]) -> Column:
    return F.element_at(F.array(*(F.lit(float(x)) for x in values)), F.col("j") + 1)


def model_terms(grams: DataFrame, langs: list[str]) -> tuple[DataFrame, np.ndarray]:
    """(kind, key, j, term) of the models of ``langs``, and the log probability of an unknown character under each.

    Kind ``n`` holds what the key of order ``n`` adds to its back-off, kind ``ORDER + n`` the log back-off weight of a
    context of order ``n``; ``j`` is the place of the language. A key's ending is in the table below, so the terms add up.
    """
    j = (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int").alias("j")
    tables = {ORDER: grams.select(j, F.col("gram").alias("key"), F.col("n").cast("double").alias("number"))}
    for n in range(ORDER - 1, 0, -1):  # how many different characters stand before
        ending = F.col("key").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("key")
        shorter = tables[n + 1].groupBy("j", ending).agg(F.count("*").cast("double").alias("number"))
        tables[n] = materialise(shorter, "language-orders")
    size = tables[1].select("key").distinct().count() + 1
    terms, below = [], None
    for n in range(1, ORDER + 1):
        once, twice = (F.count(F.when(F.col("number") == x, 1)) for x in (1, 2))
        rows = tables[n].groupBy("j").agg(once.alias("once"), twice.alias("twice")).collect()
        of = {r["j"]: r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] and r["twice"] else 0.5 for r in rows}
        discount = _of_lang([of[i] for i in range(len(langs))])
        table = tables[n].withColumn("context", F.shiftrightunsigned("key", 16))
        context = table.groupBy("j", "context").agg(F.sum("number").alias("total"), F.count("*").alias("kinds"))
        context = context.withColumn("weight", discount * F.col("kinds") / F.col("total"))
        table = table.join(context, ["j", "context"])
        if n == 1:
            unknown = {r["j"]: np.log(r["weight"] / size) for r in context.collect()}
            table = table.withColumn("low", F.lit(1 / size))
        else:
            terms.append(context.select(F.lit(ORDER + n).alias("kind"), F.col("context").alias("key"), "j", F.log("weight").alias("term")))
            table = table.withColumn("ending", F.col("key").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))).join(below, ["j", "ending"])
        p = (F.col("number") - discount) / F.col("total") + F.col("weight") * F.col("low")
        table = materialise(table.select("j", "key", "weight", "low", p.alias("p")), "language-probabilities")
        term = F.log("p") - F.log("weight") - F.log("low")
        terms.append(table.select(F.lit(n).alias("kind"), "key", "j", term.alias("term")))
        below = table.select("j", F.col("key").alias("ending"), F.col("p").alias("low"))
    every = terms[0]
    for more in terms[1:]:
        every = every.union(more)
    return every, np.array([unknown[i] for i in range(len(langs))])


@dataclass(frozen=True)
class Terms:
    """A block of terms: for each kind sorted keys, where the terms of each begin, and their languages and values."""

    unknown: np.ndarray
    kinds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def costs(self, grams: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Nats of the grams, each as often as in ``times``, under each language."""
        out = -times.sum() * self.unknown
        for kind, (keys, begins, langs, values) in self.kinds.items():
            wanted = _suffix(grams, kind) if kind <= ORDER else _suffix(grams, kind - ORDER) >> np.uint64(16)
            at, hit = _find(keys, wanted)
            first, weight = begins[at[hit]], times[hit]
            n = begins[at[hit] + 1] - first
            for i in range(0, len(n), _STEP):
                part = n[i : i + _STEP]
                flat = np.repeat(first[i : i + _STEP] - np.cumsum(part) + part, part) + np.arange(part.sum())
                out -= np.bincount(langs[flat], values[flat] * np.repeat(weight[i : i + _STEP], part), len(out))
        return out


def _block(rows: pa.Table, unknown: np.ndarray) -> Terms:
    kind, key, lang, term = (rows.column(c).to_numpy() for c in ("kind", "key", "j", "term"))
    key, kinds = key.view(np.uint64), {}
    for k in np.unique(kind):
        mine = np.flatnonzero(kind == k)
        mine = mine[np.lexsort((lang[mine], key[mine]))]
        keys, begins = np.unique(key[mine], return_index=True)
        kinds[int(k)] = keys, np.append(begins, len(mine)), lang[mine], term[mine]
    return Terms(unknown, kinds)


@dataclass(frozen=True)
class Fitted:
    """Languages, the log probability of an unknown character under each, and the table of terms with their ``block``."""

    langs: list[str]
    unknown: np.ndarray
    terms: DataFrame
    n_blocks: int

    def blocks(self) -> Iterator[Terms]:
        for b in range(self.n_blocks):
            yield _block(self.terms.filter(F.col("block") == b).toArrow(), self.unknown * (b == 0))


def fit(
    training: DataFrame, text_col: str = "text", lang_col: str = "lang", block_terms: int = 1 << 22,
) -> Fitted | None:
    """Models of all languages of ``training`` with all sequences, in blocks of about ``block_terms``; None without any."""
    grams = materialise(count_grams(training, text_col, lang_col), "language-grams")
    langs = sorted(r["lang"] for r in grams.select("lang").distinct().collect())
    if not langs:
        return None
    terms, unknown = model_terms(grams, langs)
    terms = materialise(terms, "language-terms")
    n_blocks = -(-terms.count() // block_terms)
    block = F.pmod(F.xxhash64("kind", "key"), F.lit(n_blocks)).cast("int")
    terms = terms.withColumn("block", block)
    if n_blocks > 1:
        terms = materialise(terms.repartition("block").sortWithinPartitions("block"), "language-blocks")
    return Fitted(langs, unknown, terms, n_blocks)


def _costs_of_block(rows: DataFrame, terms: Terms) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        width = len(terms.unknown)
        for batch in batches:
            for start, data, bounds in pieces(batch.column(1)):
                keys, first, has_letter = grams_of_piece(data, bounds)
                costs = np.zeros((len(bounds) - 1, width))
                for i in range(len(bounds) - 1):
                    if has_letter[i]:
                        grams, times = np.unique(keys[first[i] : first[i + 1]], return_counts=True)
                        costs[i] = terms.costs(grams, times) / times.sum()
                offsets = pa.array(np.arange(0, costs.size + 1, width, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(bounds) - 1), pa.array(np.diff(first).astype(np.int64)),
                        pa.array(has_letter), pa.ListArray.from_arrays(offsets, pa.array(costs.ravel())),
                    ],
                    names=["_id", "n", "has_letter", "costs"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n bigint, has_letter boolean, costs array<double>")


def cross_entropies(docs: DataFrame, models: Fitted, id_col: str, text_col: str) -> DataFrame:
    """(id, n, has_letter, costs): characters, and nats per character under each language.

    One pass over the texts for each block, written before the next block is read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if models.n_blocks == 1:
        return materialise(_costs_of_block(rows, next(models.blocks())), "language-costs")
    row = F.struct("_id", F.xxhash64("_text").alias("text"), F.col("_text").isNull().alias("null"))
    rows = rows.select(row.alias("_id"), "_text")
    parts = [
        materialise(_costs_of_block(rows, block).dropDuplicates(["_id"]), "language-costs").withColumn("block", F.lit(b))
        for b, block in enumerate(models.blocks())
    ]
    every = parts[0]
    for more in parts[1:]:
        every = every.union(more)
    summed = every.groupBy("_id").agg(
        F.first("n").alias("n"), F.first("has_letter").alias("has_letter"),
        F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("parts"),
    )
    zero = F.transform(F.col("parts")[0]["costs"], lambda _: F.lit(0.0))
    costs = F.aggregate("parts", zero, lambda total, p: F.zip_with(total, p["costs"], lambda x, y: x + y))
    summed = summed.select(F.col("_id").alias("_row"), "n", "has_letter", costs.alias("costs"))
    out = rows.select("_id").join(summed, F.col("_id").eqNullSafe(F.col("_row")))
    return materialise(out.select("_id._id", "n", "has_letter", "costs"), "language-costs")


def _mapped(values: dict[str, float]) -> Column:
    """A map literal."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")


def identify(
    docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    deviations: float = 4.0, block_terms: int = 1 << 22,
) -> DataFrame:
    """``lang_pred``, ``score`` and ``accepted`` for every document, learned from ``training``.

    The limit of a language is the mean cross-entropy of its training texts plus ``deviations`` standard deviations. A
    text above it keeps its language as the best guess, with ``accepted`` false and a score that falls to 0.
    """
    models = fit(training, text_col, lang_col, block_terms)
    if models is None:
        return docs.select(id_col, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    scored = cross_entropies(docs, models, id_col, text_col)
    cost = F.array_min("costs")
    langs = F.array(*(F.lit(x) for x in models.langs))
    best = F.when(F.col("has_letter"), langs[F.array_position("costs", cost).cast("int") - 1])
    scored = scored.select("*", best.alias("best"), cost.alias("cost"))
    known = training.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang")).dropna()
    own = scored.join(known, (scored["_id"] == known["_id"]) & (scored["best"] == known["_lang"]), "left_semi")
    spread = {r["best"]: (r["m"], r["s"]) for r in own.groupBy("best").agg(F.avg("cost").alias("m"), F.stddev_pop("cost").alias("s")).collect()}
    limits = _mapped({k: m + deviations * max(s, 0.02) for k, (m, s) in spread.items()})
    spreads = _mapped({k: max(s, 0.02) for k, (_, s) in spread.items()})
    sharp = F.least(F.col("n").cast("double"), F.lit(20.0))
    surety = 1 / F.aggregate("costs", F.lit(0.0), lambda total, c: total + F.exp((F.col("cost") - c) * sharp))
    excess = F.coalesce((F.col("cost") - limits[F.col("best")]) / spreads[F.col("best")], F.lit(0.0))
    accepted = F.col("has_letter") & (excess <= 0)
    score = F.when(F.col("has_letter"), surety * F.exp(-F.greatest(excess, F.lit(0.0)) / 4)).otherwise(0.0)
    return scored.select(
        F.col("_id").alias(id_col), F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"),
        accepted.alias("accepted"),
    )
