from collections import defaultdict

import numpy as np
import pytest

from roadspeed.llm import quality_classifier as qc
from roadspeed.llm.quality_rules import host_rates, quality_rules
from roadspeed.llm.queries import QUERIES
from tests.llm.helpers import WORD, rows_of

SF = "/root/testdata/sf0.001"


def counts(text):
    words = WORD.findall(text or "")
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    at, cover = defaultdict(list), set()
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    for places in at.values():
        if len(places) > 1:
            cover.update(j for i in places for j in range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(cover)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_counts_match_brute_force(spark, documents):
    found = rows_of(QUERIES["op2_quality_rules"](spark, SF))
    for doc in documents.collect():
        r = found[doc.doc_id]
        want = counts(doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_odd_texts(odd):
    got = sorted((r.doc_id, *list(r)[1:6]) for r in quality_rules(odd).collect())
    want = sorted((r.doc_id, *counts(r.text)) for r in odd.collect())
    assert got == want
    assert quality_rules(odd.limit(0)).count() == 0


def test_a_bad_host_takes_its_good_documents_along(docs_of):
    good = "one two three four five six seven eight nine ten eleven twelve {}"
    rows = [(i, "junk " * 40, "en", "bad") for i in range(60)] + [(60, good.format(0), "en", "bad")]
    rows += [(100 + i, good.format(i), "en", "fine") for i in range(60)] + [(199, good.format(9), "en", None)]
    found = rows_of(quality_rules(docs_of(rows)))
    assert not found[60].kept and not found[60].base_failed and found[60].host_rejected
    assert found[100].kept and found[199].kept and not found[0].kept


def test_a_host_of_one_document_is_shrunk_to_the_others(spark):
    rows = [("a", True)] + [(h, False) for h in "bcdefgh" for _ in range(50)]
    rates = {r["_host"]: r["bad_rate"] for r in host_rates(spark.createDataFrame(rows, "h string, bad boolean"), ["bad"], "h").collect()}
    assert rates["a"] < 0.6 and rates["b"] < 0.05


def test_scores_separate_held_out_labels(spark):
    scored = QUERIES["op1_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = scored.join(labels, "doc_id").filter("held_out").toPandas()
    assert scored.count() == 1000 and scored.filter("score BETWEEN 0 AND 1").count() == 1000
    assert ((held["score"] >= 0.7) == (held["quality"] == 1)).mean() > 0.95
    assert (held["predicted"] == (held["score"] >= 0.7)).all()


def test_density_difference_equals_the_formula():
    rng = np.random.default_rng(1)
    means = rng.normal(size=(2, 3))
    covs = [(lambda a: a @ a.T + np.eye(3))(rng.normal(size=(3, 3))) for _ in range(2)]
    x = rng.normal(size=(5, 3))
    model = qc.Discriminant(0.3, tuple(means), tuple(map(np.linalg.cholesky, covs)))
    logs = [
        np.log(p) - 0.5 * np.log(np.linalg.det(c)) - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        for p, m, c in zip((0.7, 0.3), means, covs)
    ]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_classifier_on_odd_texts_and_without_labels(spark, odd):
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (8, 1, 0), (2, 0, 0), (5, None, 0), (6, 7, 0)], "doc_id bigint, quality int, label int")
    scored = qc.classify(odd, labels).collect()
    assert len(scored) == 9 and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in qc.classify(odd, labels.filter("quality = 1")).collect()} == {1.0}
    assert {r.score for r in qc.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert qc.classify(odd.limit(0), labels).count() == 0
