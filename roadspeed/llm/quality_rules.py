"""Quality rules with host verdicts.

Row rules are counted on every whole text. Failures are summed by host; each host's failure rate is shrunk towards an
empirical beta prior fitted to all hosts, and hosts whose shrunk rate passes the limit are rejected, which is joined
back to their documents.

Null or empty text has no words and fails the base rule. A null host is a host of its own. Equal rows are judged
alike; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.texts import (
    map_texts, mix, prefix_hash, range_hash, shingle_hashes, sums, table_of, word_ranges,
)
from roadspeed.session import materialise

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
WINDOW = 5
_IS_SYMBOL = table_of(tuple(b"#*$%&|<>"))
_BY_TEXT = np.uint64(0xD6E8FEB86659FD93)



def row_rules() -> dict[str, Column]:
    words = F.col("n_words")
    return {
        "base": (words < 10) | (100 * F.col("n_repeat_words") > 20 * words),
        "symbols": 10 * F.col("n_symbols") > words,
        "lines": 10 * F.col("n_dup_lines") > words,
        "word_length": (F.col("word_chars") > 30 * words) | (F.col("word_chars") < 2 * words),
    }


def _of_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mix(hashes ^ (text.astype(np.uint64) * _BY_TEXT))


def count_piece(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    n_texts = len(bounds) - 1
    prefix = prefix_hash(data)
    starts, ends, first = word_ranges(data, bounds)
    n_words = np.diff(first)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    in_word[ends] -= 1  # a word that ends where the next text's word starts leaves zero, so it runs on
    in_word = np.cumsum(in_word[:-1], dtype=np.int8) > 0
    chars = sums(in_word & ((data & 0xC0) != 0x80), bounds)
    symbols = sums(_IS_SYMBOL[data], bounds)

    begins = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    begins = begins[begins < len(data)]
    stops = np.append(begins[1:], len(data))
    per_line = np.diff(np.searchsorted(starts, np.append(begins, len(data))))
    begins, stops = begins[per_line > 0], stops[per_line > 0]
    text_of_line = np.searchsorted(bounds, begins, "right") - 1
    stops = stops - (data[stops - 1] == 10) if len(stops) else stops
    lines = _of_text(range_hash(prefix, begins, stops), text_of_line)
    distinct = np.unique(lines, return_index=True)[1]
    dup_lines = np.bincount(text_of_line, minlength=n_texts) - np.bincount(text_of_line[distinct], minlength=n_texts)

    repeats = np.zeros(n_texts, np.int64)
    text_of_word = np.repeat(np.arange(n_texts), n_words)
    windows = shingle_hashes(range_hash(prefix, starts, ends), WINDOW)
    whole = text_of_word[: len(windows)] == text_of_word[WINDOW - 1 :][: len(windows)]
    at = np.flatnonzero(whole)
    keys = _of_text(windows[at], text_of_word[at])
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(twice):
        hit = at[np.isin(keys, twice)]
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        repeats = sums(np.cumsum(cover[:-1]) > 0, first)
    return [n_words.astype(np.int64), chars, symbols, dup_lines.astype(np.int64), repeats]


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Word, symbol and repeat counts of every whole text, beside the columns ``keep``."""
    return map_texts(docs, keep, text_col, count_piece, COUNTS)


def host_rates(failures: DataFrame, rules: list[str], host_col: str) -> DataFrame:
    """Per host: rows ``n`` and, for each rule, ``<rule>_rate``, the failure rate shrunk to the beta prior.

    The prior of a rule has the mean of all rows and the spread of the host rates beyond binomial noise (method of
    moments, between 1 and 10,000 rows' worth of evidence).
    """
    sums_ = [F.sum(F.col(r).cast("long")).alias(r) for r in rules]
    hosts = failures.groupBy(F.col(host_col).alias("_host")).agg(F.count("*").alias("n"), *sums_)
    moments = []
    for r in rules:
        rate = F.col(r) / F.col("n")
        moments += [
            (F.sum(r) / F.sum("n")).alias(f"{r}_mean"),
            (F.sum(F.col(r) * rate) / F.sum("n")).alias(f"{r}_square"),
        ]
    prior = hosts.agg(F.sum("n").alias("_rows"), F.count("*").alias("_hosts"), *moments)
    out = hosts.join(prior)  # one row
    for r in rules:
        mean = F.col(f"{r}_mean")
        spread = F.col(f"{r}_square") - mean * mean - mean * (1 - mean) * F.col("_hosts") / F.col("_rows")
        weight = F.when(spread > 0, F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.lit(1e4)))
        weight = F.coalesce(weight, F.lit(1e4))
        out = out.withColumn(f"{r}_rate", (F.col(r) + weight * mean) / (F.col("n") + weight))
    return out.select("_host", "n", *(f"{r}_rate" for r in rules))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", host_limit: float = 0.6
) -> DataFrame:
    """Counts, ``base_failed``, ``host_rejected`` and ``kept`` per document.

    A host is rejected if the shrunk rate of any rule is above ``host_limit``: most of what it holds is bad.
    """
    rules = row_rules()
    source = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_of"), F.col(text_col).alias("_text"))
    counted = materialise(text_counts(source, ["_id", "_of"], "_text"), "quality-rules")
    marked = counted.select("*", *(c.alias(r) for r, c in rules.items()))
    bad = F.greatest(*(F.col(f"{r}_rate") for r in rules)) > host_limit
    verdict = host_rates(marked, list(rules), "_of").select("_host", bad.alias("host_rejected"))
    joined = marked.join(verdict, marked["_of"].eqNullSafe(verdict["_host"]), "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("base").alias("base_failed"), rejected.alias("host_rejected"), (~F.col("base") & ~rejected).alias("kept"),
    )
