"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line with a word goes if an equal line, or one at edit distance one (insertion, deletion or substitution of one
character), stands earlier by (document, line number). Lines without a word stay.

Equal lines are one class. Emitting every deletion variant of every line would multiply the corpus by the length of its
lines, so the neighbourhood is emitted in three steps, each on what the one before left. Two lines at distance one are
equal outside the half that holds the edit, and outside the sixteenth part that holds it:

1. the variants without the first and without the second half;
2. for lines that share such a variant, those without one of sixteen parts;
3. for parts that share it, those without one character, as hashed keys.

Lines of one length whose variants are equal at the same place differ in that character only, so they are all
neighbours of the earliest of them. A line that is itself another's variant is a neighbour of all that have it. So links
are listed to the earliest line, never all pairs; each is verified by edit distance.

Null text has no lines. Ids are unique or their rows equal; equal rows are one document. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.session import materialise

PARTS = 16


def text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, no, line) of every line with a word."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    lines = rows.select("_id", F.posexplode(F.split("_text", "\n", -1)).alias("no", "line"))
    return lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _halves(n: str) -> list[str]:
    """Keys of the line without either half, for a pair whose shorter line has ``n`` characters."""
    half = f"cast(({n}) div 2 as int)"
    return [
        f"xxhash64(0, {n}, left(line, {half}))",
        f"xxhash64(1, {n}, right(line, cast({n} as int) - {half}))",
    ]


def described_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, no, h1, h2, size, halves) of every line with a word."""
    lines = text_lines(docs, id_col, text_col).withColumn("size", F.length("line"))
    return lines.selectExpr(
        "_id", "no", "xxhash64(line) AS h1", "xxhash64(1, line) AS h2", "size",
        f"array({', '.join([*_halves('size'), *_halves('size - 1')])}) AS halves",
    )


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key stands in two rows or more."""
    twice = rows.groupBy(key).agg(F.count("*").alias("of")).filter("of > 1").select(key)
    return rows.join(twice, key, "left_semi")


def _parts(lines: DataFrame) -> DataFrame:
    """(first, n, size, key, part): each line without one of its parts, as the shorter and as the longer of a pair."""
    each = lines.select("first", "line", "size", F.explode(F.expr("array(size, size - 1)")).alias("n")).filter("n > 0")
    each = each.select("*", F.explode(F.expr(f"sequence(0, {PARTS - 1})")).alias("j"))
    each = each.selectExpr("*", f"(j * n) div {PARTS} AS a", f"((j + 1) * n) div {PARTS} AS b").selectExpr(
        "first", "line", "n", "size", "j", "cast(a as int) AS a", "cast(n - b as int) AS after"
    )
    return each.selectExpr(
        "first", "n", "size", "xxhash64(n, j, left(line, a), right(line, after)) AS key",
        "substring(line, a + 1, size - a - after) AS part",
    )


def neighbours(lines: DataFrame) -> DataFrame:
    """(first, other): lines at distance one, by first place; each line has the earliest of every clique it is in."""
    parts = materialise(_shared(_parts(lines), "key"), "line-parts")
    variant = "xxhash64(concat(left(part, i - 1), substring(part, i + 1)))"
    cut = parts.filter("part <> ''").selectExpr(
        "first", "size > n AS longer", "key", f"explode(transform(sequence(1, length(part)), i -> struct(i, {variant} AS v))) AS x"
    ).selectExpr("first", "longer", "key", "x.i AS i", "x.v AS v")
    heads = cut.groupBy("key", "v", "i").agg(F.min("first").alias("other"), F.count("*").alias("of"))
    substituted = cut.join(heads.filter("of > 1"), ["key", "v", "i"]).filter("first <> other").select("first", "other")
    whole = parts.filter("size = n").selectExpr("key", "first AS base", "xxhash64(part) AS v")
    inserted = cut.filter("longer").select("key", "v", "first").distinct().join(whole, ["key", "v"])
    earliest = inserted.groupBy("base").agg(F.min("first").alias("other")).select(F.col("base").alias("first"), "other")
    return substituted.union(inserted.select("first", F.col("base").alias("other"))).union(earliest).distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, no) of every line that goes."""
    lines = materialise(described_lines(docs, id_col, text_col), "lines")
    key = ["h1", "h2", "size"]
    place = F.struct("_id", "no")
    classes = lines.groupBy(*key).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("halves").alias("halves"))
    classes = materialise(classes, "line-classes")

    halves = classes.select("first", F.explode("halves").alias("key"))
    chosen = materialise(_shared(halves, "key").select("first").distinct(), "half-lines")
    wanted = chosen.groupBy(F.col("first._id").alias("_of")).agg(F.collect_list("first.no").alias("numbers"))
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).dropDuplicates(["_id"])
    texts = source.join(wanted, source["_id"] == wanted["_of"]).select("_id", "_text", F.explode("numbers").alias("no"))
    texts = texts.select(place.alias("first"), F.element_at(F.split("_text", "\n", -1), F.col("no") + 1).alias("line"))
    texts = materialise(texts.withColumn("size", F.length("line")), "line-texts")

    pairs = neighbours(texts)
    pairs = pairs.join(texts.select("first", "line"), "first").join(
        texts.select(F.col("first").alias("other"), F.col("line").alias("near")), "other"
    )
    near = pairs.filter(F.levenshtein("line", "near", 1) >= 0).groupBy("first").agg(F.min("other").alias("other"))
    known = classes.join(near, "first", "left").withColumn("earliest", F.least("first", "other"))
    known = known.filter("last > earliest").select(*key, "earliest")
    return lines.join(known, key).filter(place > F.col("earliest")).select("_id", "no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, dropped) per document; ``dropped`` has the numbers of the lines that go, from 0."""
    gone = repeated_lines(docs, id_col, text_col).groupBy("_id").agg(F.array_sort(F.collect_set("no")).alias("dropped"))
    counts = docs.select(
        F.col(id_col).alias(id_col), F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0)).alias("n")
    )
    n = F.when(F.col("n") < 0, 0).otherwise(F.col("n")).cast("bigint").alias("n_lines")
    out = counts.join(gone, counts[id_col] == gone["_id"], "left")
    return out.select(counts[id_col], n, F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def kept_text(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of the text."""
    gone = found.select(F.col(id_col).alias("_gone_id"), F.col("dropped").alias("_gone")).distinct()
    lines = F.split(F.col(text_col), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    joined = docs.join(gone, docs[id_col] == gone["_gone_id"], "left")
    return joined.withColumn(text_col, F.when(F.size("_gone") > 0, text).otherwise(F.col(text_col))).drop("_gone_id", "_gone")
