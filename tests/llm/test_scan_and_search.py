"""Language identification, secret scan and decontamination."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from roadspeed.llm import decontaminate as dc
from roadspeed.llm import language_id as li
from roadspeed.llm.queries import QUERIES
from roadspeed.llm.secret_scan import find_secrets, written
from tests.llm.helpers import rows_of, sha

SF = "/root/testdata/sf0.001"


def keys_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return li.grams_of_piece(data, np.array([0, len(data)]))[0]


def test_probabilities_of_a_context_sum_to_one():
    text = "the cat sat on the mat and the rat ate that"
    grams, counts = np.unique(keys_of(text), return_counts=True)
    models = li.kneser_ney({"en": (grams, counts)})
    letters = sorted({ord(c) for c in text}) + [0xFFFD]
    for context in ("the", "zzz", "at "):
        head = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context))
        total = np.exp(models.log_probability(np.array([head + c for c in letters], np.uint64))).sum()
        assert math.isclose(total, 1, rel_tol=1e-5)


def test_unigrams_use_continuation_counts():
    models = li.kneser_ney({"x": tuple(np.unique(keys_of("ab ab ab cb"), return_counts=True))})
    followed = Counter()
    text = "   ab ab ab cb"
    for pair in {text[i : i + 2] for i in range(2, len(text) - 1)}:
        followed[pair[1]] += 1
    order = [chr(int(k)) for k in models.keys[0]]
    assert set(order) == set(followed)
    by_probability = sorted(order, key=lambda c: -models.logs[0][order.index(c), 0])
    assert followed[by_probability[0]] == max(followed.values())


def test_models_of_many_languages_keep_every_gram(spark, docs_of):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(400)]
    langs = [f"l{i:02}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=200)), lang) for i, lang in enumerate(langs)] + [(99, None, "l00"), (98, "", "l00")]
    docs = docs_of(rows + rows[:1])
    counts = {lang: np.unique(keys_of(text), return_counts=True) for _, text, lang in rows[1:60]}
    counts["l00"] = (np.unique(keys_of(rows[0][1])), 2 * np.unique(keys_of(rows[0][1]), return_counts=True)[1])
    plain = li.kneser_ney(counts)
    for block_terms in (1 << 22, 40_000):  # one block of terms, and several
        models = li.fit(docs, block_terms=block_terms)
        assert models.langs == langs and (models.n_blocks > 1) == (block_terms < 1 << 22)
        assert models.terms.filter("kind = 4").count() == sum(len(k) for k, _ in counts.values())
        found = li.cross_entropies(docs, models, "doc_id", "text").collect()
        assert sorted(r["_id"] for r in found) == sorted(i for i, *_ in rows + rows[:1])
        for r in found:
            if r["_id"] < 60:
                grams = keys_of(rows[r["_id"]][1])
                assert np.allclose(r["costs"], -plain.log_probability(grams).mean(axis=0), atol=1e-4)


def test_held_out_languages(spark):
    found = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id"
    ).toPandas()
    held = found[found["held_out"]]
    assert len(found) == 1000 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all()


def test_languages_of_odd_texts(odd, docs_of):
    train = docs_of([(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, None, "en"), (4, "x", None)])
    train = train.withColumn("lang", train["lang"])
    found = sorted((r.doc_id, r.lang_pred, r.score) for r in li.identify(odd, train).collect())
    assert [x[1] for x in found[:3]] == ["und"] * 3 and all(x[2] == 0 for x in found[:3])
    assert {x[1] for x in found[3:]} <= {"de", "en"} and all(0 < x[2] <= 1 for x in found[3:])
    assert {r.lang_pred for r in li.identify(odd, train.limit(0)).collect()} == {"und"}
    assert li.identify(odd.limit(0), train).count() == 0


def test_letters_of_any_script_and_no_others():
    for text, letter in (("😀 1234 !?", False), ("😀", False), ("𐌰𐌱", True), ("x😀", True), ("漢", True), ("٣", False), ("", False)):
        data = np.frombuffer(f"{text}".encode(), np.uint8)
        assert li.grams_of_piece(data, np.array([0, len(data)]))[2].tolist() == [letter], text


def test_foreign_text_is_rejected(docs_of):
    rng = random.Random(1)
    words = "der die das und ist nicht ein eine mit von auf für dem den haus baum strasse wasser".split()
    rows = [(i, " ".join(rng.choices(words, k=40)), "de") for i in range(60)] + [(99, "qxz jvk wqp zzx kjq " * 20, "de")]
    docs = docs_of(rows)
    found = rows_of(li.identify(docs, docs.filter("doc_id < 60")))
    assert found[5].accepted and not found[99].accepted and found[99].score < 0.1


ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


TRICKY = [
    'é 😀 password: "abcdefgh1" x', "tOKEN=short secret=token:abcdefghij", "AKIAABCDEFGHIJKL AKIAAKIA12 AKIAABC",
    "0123456789abcdef0123456789abcdef0G" * 2, "token=token=token=12345678", "api_key : 'abc.def-ghi' apikey=12345678 ſecret=12345678",
    "secret=" + "f" * 40, "passwd\n=12345678", "a" * 32,
]


def test_spans_match_brute_force(spark, docs_of):
    rows = list(enumerate(TRICKY)) + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = rows_of(find_secrets(docs_of(rows)))
    for i, text in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in found[i].base] == base_spans(text)


def test_tokens_of_one_owner_are_added_and_copied_ones_are_not(docs_of):
    own, copied = "Zx9" + "aB3dE6gH" * 3, "Qq7" + "kL2mN5pR" * 3
    rows = [(1, f"see {own} here", "en", "a"), (2, f"{copied}", "en", "a"), (3, f"{copied}", "en", "b"), (4, "lowercaseonlylongword" * 2, "en", "c")]
    rows += [(5, f"token={own[:-1]}x", "en", "c")]
    found = find_secrets(docs_of(rows)).withColumn("all", written("spans")).withColumn("base", written("base"))
    got = {r.doc_id: (r.base, r.all, r.n_live, r.n_copied) for r in found.collect()}
    assert got[1] == ("", f"token:4:{4 + len(own)}", 1, 0)
    assert got[2] == ("", "", 0, 1) and got[3] == got[2] and got[4] == ("", "", 0, 0)
    assert got[5][0] == got[5][1] == f"assign:0:{6 + len(own)}"


def test_a_value_in_many_repositories_of_one_owner_is_no_live_token(docs_of):
    value = "Zx9" + "aB3dE6gH" * 3
    found = find_secrets(docs_of([(i, value, "en", "a") for i in range(5)]))
    assert {r.n_live for r in found.collect()} == {0}


def test_secrets_of_odd_texts_and_the_digest(spark, odd):
    assert {(len(r.base), len(r.spans)) for r in find_secrets(odd).collect()} == {(0, 0)}
    assert find_secrets(odd.limit(0)).count() == 0
    r = rows_of(QUERIES["op7_secret_scan"](spark, SF))
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for i, text in texts.items():
        spans = base_spans(text)
        assert r[i].base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode())
        assert (r[i].n_assign, r[i].n_access, r[i].n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))


def edit_distance_anywhere(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row), row.index(min(row))


def test_verification_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        p, t = (bytes(rng.choices(b"abc", k=rng.randint(a, 70))) for a in (1, 0))
        edits, end = edit_distance_anywhere(p, t)
        assert dc.best_end(p, t) == (edits, end)


def test_distances_side_by_side():
    rng = random.Random(4)
    sizes = (1, 5, 63, 64, 65, 128, 200, 513, 600)
    patterns = [bytes(rng.choices(b"abc", k=rng.choice(sizes))) for _ in range(40)]
    which = np.array([rng.randrange(40) for _ in range(300)])
    texts = [bytes(rng.choices(b"abc", k=rng.randint(0, 300))) for _ in which]
    assert dc.least_edits(patterns, which, texts).tolist() == [dc.best_end(patterns[i], t)[0] for i, t in zip(which, texts)]
    assert dc.least_edits(patterns, which[:0], []).tolist() == []


def damaged(text, n, rng):
    text = list(text)
    for _ in range(n):
        i = rng.randrange(len(text))
        rng.choice([lambda: text.__setitem__(i, rng.choice("abcxyz ")), lambda: text.insert(i, rng.choice("abcxyz")), lambda: text.pop(i)])()
    return "".join(text)


def test_leaks_reach_the_target_recall(spark, docs_of):
    rng = random.Random(2)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    clean = [t for t in texts if not any(x in t for x in items.values())]
    rows, want = [], {}
    for share in (0, 0.05, 0.1):
        for item, text in items.items():
            want[len(rows)] = item
            rows.append((len(rows), f"{rng.choice(clean)[:900]} {damaged(text, int(share * len(text)), rng)}\n{rng.choice(clean)[:400]}"))
    bench = spark.createDataFrame([*items.items(), (None, "x"), (9999, None), (9998, ""), (9997, "!?")], "item_id long, text string")
    for block_bytes in (1 << 21, 2_000):  # one block of items, and several
        found = rows_of(dc.find_leaks(docs_of(rows), bench, block_bytes=block_bytes))
        hit = [want[i] in {h["item"] for h in found[i].hits} for i in want]
        assert np.mean(hit) >= 0.95 and all(hit[: len(items)])
    h = found[0].hits[0]
    assert rows[0][1].encode()[h["start"] : h["end"]].decode() == items[want[0]].strip(" .!?") and h["edits"] == 0


@pytest.mark.parametrize("spread", [True, False])
def test_no_passage_within_the_bound_is_lost(spread):
    rng = random.Random(7)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400))
    items = [bytes(text[:size], "ascii") for size in range(8, 401, 7)]
    for i, item in enumerate(items):
        most = int(0.15 * len(item))
        places = [int((k + 1) * len(item) / (most + 1)) for k in range(most)] if spread else rng.sample(range(1, len(item) - 1), most)
        copy = bytearray(item)
        for k in places:
            copy[k] = ord("9")
        data = np.frombuffer(b"some words before " + bytes(copy) + b" and after", np.uint8)
        found = dc.hits_of_piece(data, np.array([0, len(data)]), dc.Items([i], [item], 12, 0.15))
        assert [h[0] for h in found[0]] == [i] and found[0][0][3] <= most, len(item)


def pieces_of_words(rng, words, items, me=0.15):
    """Texts of random words, some with a damaged item, as one array with bounds."""
    texts = []
    for _ in range(30):
        item = rng.choice(items).decode()
        inner = damaged(item, rng.randint(0, int(me * len(item)) + 2), rng) if rng.random() < 0.7 else ""
        texts.append(" ".join([*rng.choices(words, k=rng.randint(0, 60)), inner, *rng.choices(words, k=rng.randint(0, 60))]).encode())
    return texts, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


@pytest.mark.parametrize("bands", [1 << 19, 500, 1])
def test_items_found_are_those_of_brute_force(monkeypatch, bands):
    monkeypatch.setattr(dc, "_BANDS", bands)  # dense counts, texts in several shares, sparse counts
    rng = random.Random(bands)
    words = ["abc", "xya", "ca", "bxzyca", "zz", "caab"]
    for me in (0.15, 0.05, 0.3):
        items = list({" ".join(rng.choices(words, k=k)).encode() for k in (3, 4, 5, 8, 12, 20, 30)})
        items = [x for x in items if len(x) >= 12]
        texts, data, bounds = pieces_of_words(rng, words, items, me)
        found = dc.hits_of_piece(data, bounds, dc.Items(list(range(len(items))), items, 12, me))
        for text, hits in zip(texts, found):
            one = np.frombuffer(text, np.uint8)
            form = dc.normal_form(one, np.array([0, len(one)]))[0].tobytes()
            least = [edit_distance_anywhere(x, form)[0] for x in items]
            bound = [int(me * len(x)) if max(len(x) // n - int(me * len(x)) for n in range(1, 13)) > 0 else -1 for x in items]
            assert {h[0] for h in hits} == {i for i, k in enumerate(least) if k <= bound[i]}


def test_few_places_without_a_passage_are_compared():
    rng = random.Random(3)
    parts = "tion ing the er an st ou ha re in thea on es nd at".split()
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(600)]
    items = [" ".join(rng.choices(words, k=rng.randint(12, 50))).encode() for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=400)).encode() for _ in range(40)]
    texts[7] += b" " + items[5]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    items = dc.Items(list(range(200)), items, 12, 0.15)
    form, edges, _ = dc.normal_form(data, bounds)
    ranges = dc._ranges(form, edges, items)
    assert (7, 5) in set(map(tuple, ranges[:, :2].tolist()))
    assert len(ranges) < len(dc._proposals(form, edges, 0, items)) / 10


@pytest.mark.parametrize("codes", [[], [7], [3, 9, 1 << 40, (1 << 63) + 5], list(range(5000))])
def test_codes_are_found_where_slots_are_shared(codes):
    strings = dc.Strings(np.array(codes, np.uint64))
    asked = np.array([*codes, 6000, 1 << 50], np.uint64)
    at, place = strings.find(asked)
    assert at.tolist() == list(range(len(codes))) == place.tolist()


def test_clean_documents_have_no_leak(spark, odd):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [r.text for r in bench.collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = rows_of(QUERIES["op10_decontaminate"](spark, SF))
    for i, text in docs.items():
        assert found[i].contaminated == any(x in text for x in items)
    got = dc.find_leaks(odd, bench)
    assert got.count() == 9 and all(not r.hits for r in got.collect())
    assert dc.find_leaks(odd.limit(0), bench).count() == 0
    assert all(not r.hits for r in dc.find_leaks(odd, bench.limit(0)).collect())


@pytest.mark.parametrize("text,hit", [("say Hi there now", True), ("shi there", False), ("HI,THERE", True), ("hi thereby", False)])
def test_short_items_are_whole_words(spark, docs_of, text, hit):
    bench = spark.createDataFrame([(1, "hi there!")], "item_id long, text string")
    assert bool(dc.find_leaks(docs_of([(1, text)]), bench).first().hits) == hit
