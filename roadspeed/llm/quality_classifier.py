"""Quality classifier: regularised quadratic discriminant analysis on statistics of whole texts.

Each text becomes a short vector of transformed statistics. Class counts, means and second moments are summed by
Spark over all labelled rows; the covariances are shrunk towards the pooled one and its diagonal, factorised once by
Cholesky, and a document's score is the logistic of the difference of the two class log densities, each from a
Mahalanobis distance by triangular solution.

Null and empty texts have the statistics of no words and get a score like any other. Labels other than 0 and 1, and
null labels, are not learned from; without rows of both classes the score is the share of label 1 (0.5 without any).
Repeated label rows count as often as they stand there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.llm.quality_rules import count_piece
from roadspeed.llm.texts import map_texts, prefix_hash, range_hash, sums, table_of, word_ranges
from roadspeed.session import materialise

FEATURES = (
    "log_words", "log_bytes_per_word", "upper", "digit", "mark", "shout", "symbol", "dup_lines", "repeats",
    "log_words_per_line", "capital_words", "word_spread", "fresh", "other_ascii",
)
_UPPER = table_of(tuple(range(65, 91)))
_DIGIT = table_of(tuple(range(48, 58)))
_MARK = table_of(tuple(b".,;:?"))
_SHOUT = table_of(tuple(b"!"))
_OTHER = table_of(tuple(b"#*$%&|<>@/\\^_~=+-[](){}\"'`"))
_ALPHA = table_of((*range(65, 91), *range(97, 123), *range(128, 256)))


def _share(part: np.ndarray, whole: np.ndarray, noise: float = 1.0) -> np.ndarray:
    """Share on a root scale, which spreads small shares and keeps large ones finite."""
    return np.sqrt((part + 0.01) / (whole + noise))


def describe_piece(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    n_words, chars, symbols, dup_lines, repeats = count_piece(data, bounds)
    starts, ends, first = word_ranges(data, bounds)
    size = np.diff(bounds)
    lengths = (ends - starts).astype(float)
    total, square = np.concatenate([[0], np.cumsum(lengths)]), np.concatenate([[0], np.cumsum(lengths**2)])
    held = np.maximum(n_words, 1)
    mean = (total[first[1:]] - total[first[:-1]]) / held
    spread = np.sqrt(np.maximum((square[first[1:]] - square[first[:-1]]) / held - mean**2, 0))
    letters = sums(_ALPHA[data], bounds)
    lines = sums(data == 10, bounds) + 1
    text_of_word = np.repeat(np.arange(len(size), dtype=np.uint64), n_words)
    words = range_hash(prefix_hash(data), starts, ends) ^ (text_of_word * np.uint64(0xD6E8FEB86659FD93))
    seen = np.unique(words, return_index=True)[1]
    distinct = np.bincount(text_of_word[seen].astype(np.int64), minlength=len(size))
    columns = [
        np.log1p(n_words), np.log1p(mean), _share(sums(_UPPER[data], bounds), letters, 10),
        _share(sums(_DIGIT[data], bounds), size, 10), _share(sums(_MARK[data], bounds), n_words, 5),
        _share(sums(_SHOUT[data], bounds), n_words, 5), _share(sums(_OTHER[data], bounds), n_words, 5),
        _share(dup_lines, lines, 2), _share(repeats, n_words, 5), np.log1p(n_words / lines),
        _share(sums(_UPPER[data[starts]], first), n_words, 5), np.log1p(spread),
        np.log1p(distinct) - 0.8 * np.log1p(n_words), _share(symbols, n_words, 5),
    ]
    flat = np.stack(columns, axis=1).astype(float).ravel()
    width = len(columns)
    return [pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat))]


def describe(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``features``, an array of ``FEATURES``, for every whole text."""
    return map_texts(docs, keep, text_col, describe_piece, "features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class shares, means and lower Cholesky factors; ``factors`` is empty if one class has no rows."""

    share: float
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.share)
        logs = []
        for share, mean, factor in zip((1 - self.share, self.share), self.means, self.factors):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(np.log(share) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(rows: DataFrame, pooled: float = 0.1, diagonal: float = 0.05) -> Discriminant:
    """Fit to ``features`` and ``label`` (0 or 1) of all rows.

    ``pooled`` is the weight of the pooled covariance in each class's own, ``diagonal`` that of its diagonal.
    Only sums come to the driver: one number for each pair of features and class.
    """
    n = len(FEATURES)
    x = [F.col("features")[i] for i in range(n)]
    moments = [F.sum(a).alias(f"s{i}") for i, a in enumerate(x)]
    moments += [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(n) for j in range(i, n)]
    found = {r["label"]: r for r in rows.filter("label IN (0, 1)").groupBy("label").agg(F.count("*").alias("n"), *moments).collect()}
    counts = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    if not all(counts):
        return Discriminant(counts[1] / sum(counts) if sum(counts) else 0.5)
    means, covs = [], []
    for k in (0, 1):
        r = found[k]
        mean = np.array([r[f"s{i}"] for i in range(n)]) / r["n"]
        second = np.array([[r[f"q{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)]) / r["n"]
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
    both = (covs[0] * counts[0] + covs[1] * counts[1]) / sum(counts)
    factors = []
    for cov, count in zip(covs, counts):
        own = (1 - pooled) * cov + pooled * both
        own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + np.eye(n) * (1e-4 + 1 / count)
        factors.append(np.linalg.cholesky(own))
    return Discriminant(counts[1] / sum(counts), tuple(means), tuple(factors))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.7,
) -> DataFrame:
    """``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` for every document.

    ``labels`` holds the rows to learn from; leave out what is to be held out.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    described = materialise(describe(source, ["_id"], "_text"), "quality-features")
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    model = fit(described.join(known, "_id"))

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["_id", "score"])

    kind = described.schema["_id"].dataType.simpleString()
    scored = described.select("_id", "features").mapInArrow(run, f"_id {kind}, score double")
    return scored.select(F.col("_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
