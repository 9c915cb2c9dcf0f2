"""Line dedup, n-gram join and suffix dedup against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from roadspeed.llm.components import components
from roadspeed.llm.line_dedup import dedup_lines, kept_text
from roadspeed.llm.ngram_join import ngram_components, prefix_length
from roadspeed.llm.queries import QUERIES
from roadspeed.llm.suffix_dedup import _sliding_min, remove_repeats
from tests.llm.helpers import WORD, rows_of, sha

SF = "/root/testdata/sf0.001"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def dropped_lines(docs):
    lines = [(i, no, line) for i, text in sorted(docs.items()) if text for no, line in enumerate(text.split("\n")) if WORD.search(line)]
    out = defaultdict(list)
    for k, (i, no, line) in enumerate(lines):
        if any(within_one(line, earlier) for *_, earlier in lines[:k]):
            out[i].append(no)
    return out


def test_lines_match_brute_force(docs_of):
    rng = random.Random(3)
    base = ["", "a", "ab", "x" * 40, "Seite 1", "größer als 漢字 😀 sein", "the quick brown fox jumps over the lazy dog again and again"]

    def edited(line):
        i = rng.randint(0, len(line))
        return rng.choice([line, line[:i] + rng.choice("abx ") + line[i:], line[:i] + line[i + 1 :], line[:i] + "é" + line[i + 1 :]])

    docs = {i: "\n".join(edited(edited(rng.choice(base))) for _ in range(rng.randint(1, 6))) for i in range(60)}
    want = dropped_lines(docs)
    got = rows_of(dedup_lines(docs_of(list(docs.items()))))
    assert {i: r.dropped for i, r in got.items()} == {i: want[i] for i in docs}
    assert all(got[i].n_lines == docs[i].count("\n") + 1 for i in docs)


def test_lines_of_odd_texts(odd):
    found = dedup_lines(odd)
    got = {(r.doc_id, r.n_lines, tuple(r.dropped)) for r in found.collect()}
    assert got == {(1, 0, ()), (2, 1, ()), (3, 3, ()), (4, 1, ()), (5, 1, ()), (6, 1, (0,)), (7, 1, ()), (8, 1, ())}
    kept = kept_text(odd, found)
    assert kept.columns == odd.columns and kept.count() == 9
    assert {r.text for r in kept.filter("doc_id = 6").collect()} == {""}
    assert dedup_lines(odd.limit(0)).count() == 0


def test_many_lines_of_one_pattern_cost_no_pairs(docs_of):
    rows = [(i, f"line number {chr(0x4E00 + i)} of the report") for i in range(400)]
    got = rows_of(dedup_lines(docs_of(rows)))
    assert got[0].dropped == [] and all(got[i].dropped == [0] for i in range(1, 400))


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def component_of(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) > 0:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_components_match_brute_force(docs_of, width, percent):
    rng = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=50)
    docs = {}
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 12, 60, 200]))
        for _ in range(rng.randint(1, 12)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                at = rng.randrange(len(text))
                text[at:at] = passage
            docs[len(docs) * 3 + 1] = " ".join(w.upper() if rng.random() < 0.1 else w for w in text)
    want = component_of(docs, width, percent)
    for common in (64, 1):  # the order that routes must not matter
        got = rows_of(ngram_components(docs_of(list(docs.items())), width=width, percent=percent, common=common))
        assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


def test_join_of_odd_texts(odd):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(odd).collect())
    long = {r.doc_id: len(shingles(r.text, 4)) for r in odd.collect()}[8]
    odd_one = len(shingles("é ß 漢字 😀 \u0000x", 4))
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 3, 5), (5, 3, 5), (6, 3, 5), (7, odd_one, 7), (8, long, 8)]
    assert ngram_components(odd.limit(0)).count() == 0


def test_prefixes_are_as_long_as_the_bound_needs():
    for n in range(1, 300):
        for percent in (80, 85):
            assert prefix_length(n, percent) == n - min(o for o in range(n + 1) if 100 * o >= percent * n) + 1


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(5, 5), (29, 60), (60, 29)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 141)} | {i: 1 for i in range(2, 30)} | {60: 1}
    assert {k: v for k, v in got.items() if k != v} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(docs, length):
    texts = {i: (t or "").encode() for i, t in docs}
    counts = Counter(b[s : s + length] for b in texts.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in texts.items():
        gone = set()
        for s in range(len(b) - length + 1):
            if counts[b[s : s + length]] > 1:
                gone.update(range(s, s + length))
        spans = sum(p in gone and p - 1 not in gone for p in range(len(b)))
        out[i] = (len(b), len(gone), spans, bytes(c for p, c in enumerate(b) if p not in gone))
    return out


@pytest.mark.parametrize("length,q", [(400, 32), (40, 8), (9, 8)])
def test_removal_matches_brute_force(docs_of, length, q):
    rng = random.Random(length)
    alphabet = "abcdeé \n"
    passages = ["".join(rng.choices(alphabet, k=k)) for k in (length // 2, length - 1, length, length + 1, 2 * length, 3 * length)]
    rows = [(0, None), (1, ""), (2, "a" * (length - 1)), (3, "b" * length), (4, "c" * (2 * length)), (5, "é" * length)]
    for i in range(6, 40):
        parts = [rng.choice([rng.choice(passages), "".join(rng.choices(alphabet, k=rng.randint(0, length)))]) for _ in range(rng.randint(1, 5))]
        rows.append((i, "".join(parts)))
    rows.append((90, rows[10][1]))
    rows.append((91, rows[11][1][: len(rows[11][1]) // 2]))
    got = rows_of(remove_repeats(docs_of(rows), length=length, q=q))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for i, r in got.items()} == removed(rows, length)


def test_removal_on_the_table_and_on_odd_texts(spark, odd):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = removed(docs, 400)
    got = rows_of(QUERIES["op5_suffix_dedup"](spark, SF))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == {
        i: (*w[:3], sha(w[3])) for i, w in want.items()
    }
    assert remove_repeats(odd).count() == 9 and remove_repeats(odd.limit(0)).count() == 0


def test_sliding_minimum():
    import numpy as np

    x = np.random.default_rng(1).integers(0, 99, 50)
    for width in (1, 2, 3, 7, 8, 50):
        assert _sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(51 - width)]
