"""Packing: ids against the tokenizer, laws of the packing, and its size against sequential best fit."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check import ROOT
from roadspeed.llm.packing import WordIds, best_fit, pack, sequences
from roadspeed.llm.queries import op12_packing

FILE = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def coder():
    with open(FILE, encoding="utf-8") as file:
        return WordIds(file.read(), 0, most=50)


PARTS = st.sampled_from([
    " ", "\n", "\t\x0b", "\x0c\r", "\x1c", "\x85", "\xa0", " ", "　", "a", "Ab", "É", "é", "́", "ΑΣ", "İ", "ß", "'s", "'LL",
    "12", "½", "!?", "<|endoftext|>", "<|startoftext|> ", "<|ENDOFTEXT|>", "漢字", "가", "가", "😀", "‍", "\x00", "the", "_x",
])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join) | st.text(max_size=30), min_size=1, max_size=4))
def test_ids_are_the_tokenizers(coder, texts):
    ids, ends = coder.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [PLAIN.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def sequential(lengths, capacity):
    """The number of sequences of best fit, longest first."""
    rooms = np.zeros(capacity + 1, int)
    for n in sorted(lengths, reverse=True):
        fitting = np.flatnonzero(rooms[n:])
        room = n + fitting[0] if len(fitting) else capacity
        rooms[room] -= bool(len(fitting))
        rooms[room - n] += 1
    return rooms.sum()


@pytest.mark.parametrize("kind", ["mixed", "same", "small", "thirds", "full"])
def test_best_fit(spark, kind):
    rng = np.random.default_rng(5)
    lengths = {
        "mixed": np.minimum(rng.geometric(1 / 40, 3000), 100), "same": np.full(700, 33), "small": rng.integers(1, 6, 2000),
        "thirds": np.concatenate([rng.integers(20, 36, 1500), np.full(800, 21)]), "full": np.array([100, 100, 1, 99, 50, 50, 51]),
    }[kind]
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "k bigint, length int")
    placed = best_fit(df, "k", "length", capacity=100, bucket=64).toPandas()
    assert sorted(placed["k"]) == list(range(len(lengths)))
    filled = np.bincount(placed["sequence_id"], lengths[placed["k"]])
    assert filled.max() <= 100 and filled.min() > 0
    assert len(filled) <= max(1.02 * sequential(lengths, 100), sequential(lengths, 100))


def test_query(spark):
    docs = rows_of(spark.read.parquet(f"{ROOT}/sf0.001/documents.parquet"))
    got = op12_packing(spark, f"{ROOT}/sf0.001").toPandas()
    for i, rows in got.groupby("doc_id"):
        ids = PLAIN.encode(docs[i].text or "", add_special_tokens=False).ids + [0]
        rows = rows.sort_values("piece")
        assert rows["piece"].tolist() == list(range(-(-len(ids) // 2048)))
        for r in rows.itertuples():
            part = ids[r.start : r.start + r.length]
            assert r.start == 2048 * r.piece and r.length == len(part) == min(2048, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert set(got["doc_id"]) == set(docs)
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["offset"].tolist() == (rows["length"].cumsum() - rows["length"]).tolist() and rows["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= 1.01 * sequential(got["length"], 2048)


def test_odd_texts(odd, spark):
    got = pack(odd, FILE, keep_ids=True)
    rows = got.collect()
    assert sum(r.doc_id == 5 for r in rows) == 2 and {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert pack(odd.limit(0), FILE).count() == 0
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        ids = PLAIN.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
    made = sequences(got).collect()
    assert sum(m.length for m in made) == sum(r.length for r in rows)
    by = {m.sequence_id: np.frombuffer(m.ids, "<u4").tolist() for m in made}
    for r in rows:
        assert by[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    with pytest.raises(ValueError):
        pack(odd, FILE, capacity=0)
    assert pack(odd.select("doc_id", "text"), FILE, capacity=1).agg(F.max("length")).first()[0] == 1
