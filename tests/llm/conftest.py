import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """docs_of([(id, text, lang, source), ...]): a documents table, with columns whose names may clash."""

    def make(rows):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s0"][len(r) - 2 :])) for r in rows]
        df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in full], SCHEMA)
        return df.selectExpr("*", "1 AS size", "'x' AS _id", "2 AS n", "3 AS shard", "'y' AS label")

    return make


@pytest.fixture
def odd(docs_of):
    """Nulls, empties, white space, ties, a repeated row and a long text."""
    long = " ".join(f"wort{i % 977}" for i in range(60_000))
    rows = [
        (1, None, None, None), (2, "", "en", "s1"), (3, " \t\n\x0b\n", "en", None), (4, "a", "en", "s1"),
        (5, "same words in the same order", "en", "s1"), (6, "same words in the same order", "en", "s2"),
        (7, "é ß 漢字 😀 \u0000x", "de", "s2"), (8, long, "de", "s1"),
    ]
    return docs_of(rows + rows[4:5])
