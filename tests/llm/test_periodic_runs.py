"""Periodic runs against a scan of all lags."""

import hashlib
import zlib

import numpy as np
import pytest
from helpers import WORD, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from check import ROOT
from roadspeed.llm.periodic_runs import find_runs, listed, periodic_runs, strongest
from roadspeed.llm.queries import op13_periodic_runs

LETTERS = st.lists(st.integers(0, 2), max_size=120)


def brute(words, least=24):
    """Every maximal stretch of at least three periods, by its smallest period."""
    out, seen, n = [], set(), len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            run = (at, end - at + q, q)
            if run[1] >= max(least, 3 * q) and run[:2] not in seen:
                seen.add(run[:2])
                out.append(run)
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(*texts, **how):
    """The runs of each text, all found in one pass."""
    number = {}
    codes, ends = [], []
    for i, text in enumerate(texts):
        codes += [number.setdefault(w, len(number)) for w in text] + [10**6 + i]
        ends.append(len(codes) - 1)
    found = find_runs(np.array(codes, np.int64), np.array(ends), **how).tolist()
    starts = [0] + [e + 1 for e in ends[:-1]]
    return [[(s - a, n, q) for s, n, q in found if a <= s < b] for a, b in zip(starts, ends)]


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, min_size=1, max_size=3), st.integers(1, 6), st.integers(1, 60))
def test_short_texts_at_all_scales(texts, times, tail):
    texts = [t * times + t[:tail] for t in texts]
    assert runs_of(*texts, least=3, base=1) == [brute(t, 3) for t in texts]


@settings(max_examples=60, deadline=None)
@given(LETTERS, LETTERS, st.integers(1, 9), st.integers(3, 8), st.integers(1, 40), st.integers(3, 5))
def test_nested_repeats(a, b, inner, outer, tail, base):
    block = a * inner + b
    text = (block * outer + block[:tail])[:1500] + a
    assert runs_of(text, least=9, base=base) == [brute(text, 9)]
    assert runs_of(text) == [brute(text)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("base", [1, 2, 8])
def test_words_full_of_repeats(base):
    """Fibonacci words, powers of two letters, a single word, periods on the edge of a scale."""
    rng = np.random.default_rng(3)
    texts = [fibonacci(700), [0] * 400, [0, 1] * 150 + [2] * 40 + [0, 1] * 150, ([0] * 60 + [1]) * 7]
    for q in (31, 32, 33, 63, 64, 65, 127, 128, 129):
        block = rng.integers(0, 1000, q).tolist()
        texts += [block * 3, (block * 4)[: 3 * q - 1], [5] + block * 3 + block[: q // 2] + [7]]
    least = 3 * base
    assert runs_of(*texts, least=least, base=base) == [brute(t, least) for t in texts]


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def wanted(words):
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *best, milli, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_brute_force(spark):
    docs = rows_of(spark.read.parquet(f"{ROOT}/sf0.001/documents.parquet"))
    got = rows_of(op13_periodic_runs(spark, f"{ROOT}/sf0.001"))
    assert set(got) == set(docs)
    short = [i for i in docs if len(docs[i].text or "") < 12_000]
    assert sum(got[i].n_runs > 0 for i in short) > 5
    for i in short:
        assert tuple(got[i][c] for c in COLUMNS) == wanted(planted(i, docs[i].text)), i


def test_odd_texts(odd, docs_of):
    got = rows_of(periodic_runs(odd))
    assert [got[i].n_words for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 6]
    assert got[1].collapsed == "" and got[7].collapsed == "é ß 漢字 😀 \x00x"
    assert [tuple(r) for r in got[8].runs] == [(0, 60_000, 977)]
    assert got[8].collapsed == " ".join(f"wort{i}" for i in range(977))
    assert periodic_runs(odd).count() == odd.count() and periodic_runs(odd.limit(0)).count() == 0
    tied = docs_of([(1, "a " * 30 + "x " + "b " * 30), (2, " ".join("abc"[i % 3] for i in range(23)))])
    both = rows_of(periodic_runs(tied).select("doc_id", strongest("runs").alias("best"), listed("runs").alias("text")))
    assert tuple(both[1].best) == (0, 30, 1) and both[1].text == "0,30,1\n31,30,1\n"
    assert both[2].best is None and both[2].text == ""
