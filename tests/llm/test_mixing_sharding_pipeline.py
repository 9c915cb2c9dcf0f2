import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadspeed.llm.mixing import drawn, mix
from roadspeed.llm.queries import QUERIES
from roadspeed.llm.sharding import _acceptance, shard_documents
from tests.llm.helpers import WORD, rows_of

SF = "/root/testdata/sf0.001"


def targets(sizes):
    """Excess over three times a source's words goes to the others by weight, again and again."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in open_}
        out |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def check_mix(rows, mixed, near):
    sizes, got = defaultdict(int), defaultdict(int)
    source = {}
    for i, text, _, s in rows:
        sizes[s] += len(WORD.findall(text or ""))
        source[i] = s
    want = targets(sizes)
    for r in mixed:
        assert r.size == len(WORD.findall(dict((x[0], x[1]) for x in rows)[r.doc_id] or ""))
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert len(r.draws) <= 3 and len({d["round"] for d in r.draws}) == len(r.draws)
        got[source[r.doc_id]] += r.size * len(r.draws)
    for s in sizes:
        assert abs(got[s] - want[s]) <= near(s), (s, got[s], want[s])


def test_mix_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    mixed = mix(docs).collect()
    largest = defaultdict(int)
    for _, text, _, s in rows:
        largest[s] = max(largest[s], len(WORD.findall(text)))
    check_mix(rows, mixed, lambda s: largest[s])
    assert sorted(map(str, mix(docs.repartition(3)).collect())) == sorted(map(str, mixed))
    loads = Counter(d["shard"] for r in mixed for d in r.draws)
    assert len(loads) == 8 and max(loads.values()) < 3 * min(loads.values())


def test_mix_with_small_and_hot_sources(docs_of):
    rows = [(i, "w " * 10, "en", "hot") for i in range(300)] + [(1000 + i, "w " * 7, "en", None) for i in range(20)]
    rows += [(2000, "w " * 5, "en", "tiny"), (2001, None, "en", "none"), (2002, "", "en", "none")]
    check_mix(rows, mix(docs_of(rows)).collect(), lambda s: 5)


def test_draws_repeat_rows_and_equal_rows_are_decided_alike(docs_of, odd):
    rows = [(i, "a b c", "en", s) for i, s in enumerate("aabbbbbbbbbb")]
    docs = docs_of(rows)
    mixed = mix(docs)
    out = drawn(docs, mixed).select(*docs.columns)
    assert out.columns == docs.columns
    times = Counter(r.doc_id for r in out.collect())
    assert times == Counter({r.doc_id: len(r.draws) for r in mixed.collect() if r.draws})
    found = mix(odd)
    assert found.count() == 9 and drawn(odd, found).count() >= 1 and mix(odd.limit(0)).count() == 0


def check_shards(rows, found, shards=8):
    counts = Counter(r.shard for r in found)
    assert len(found) == len(rows) and max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))


def test_shards_are_even_and_keep_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = QUERIES["op9_sharding"](spark, "/root/testdata/sf0.01").collect()
    check_shards(texts, found)
    shard = {r.doc_id: r.shard for r in found}
    groups, lines = defaultdict(list), defaultdict(list)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        groups[raw].append(r.shard)
        for line in set(texts[r.doc_id].split("\n")):
            if len(line) >= 30:
                lines[line].append(shard[r.doc_id])
    assert all(len(set(g)) == 1 for g in groups.values())
    linked = [x for x in lines.values() if len(x) > 1]
    assert sum(max(Counter(x).values()) for x in linked) > 0.7 * sum(map(len, linked))


def test_a_hot_text_is_spread_and_odd_texts_have_a_place(docs_of, odd):
    rows = [(i, "the same long line in more than half of all documents", "en", "a") for i in range(100)]
    rows += [(i, f"something else {i}", "en", "a") for i in range(100, 180)]
    check_shards(rows, shard_documents(docs_of(rows)).collect())
    check_shards(range(9), shard_documents(odd).collect())
    assert rows_of(shard_documents(odd))[1].text_crc32 == 0
    assert shard_documents(odd.limit(0)).count() == 0


def test_quotas_allow_exchange_and_room():
    allowed = _acceptance({(0, 1): 10, (1, 0): 4, (2, 1): 10}, {0: 10, 1: 10, 2: 10}, 12)
    assert allowed[1, 0] == 1.0 and allowed[0, 1] == pytest.approx((4 + 1) / 10) and allowed[2, 1] == pytest.approx(0.1)


def test_pipeline_stages_do_what_they_decide(spark, docs_of, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    base.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "decontaminate", "mixing", "sharding"]
    assert 200 > sizes[0] > sizes[1] > sizes[2] > 0 and sizes[3] == sizes[4]
    leaked = spark.read.parquet(str(tmp_path / "ngram_join")).collect()
    clean = {r.doc_id for r in leaked if not any(x in r.text for x in items)}
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "decontaminate")).collect()} == clean
    result = corpus_pipeline.run(spark, str(tmp_path))
    key = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, result.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))


def test_pipeline_on_odd_texts(spark, odd, tmp_path):
    spark.createDataFrame([(1, "no such passage anywhere at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {8}
    odd.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_stage_keeps_clashing_columns(spark, odd):
    kept = corpus_pipeline.keep_one_of_each(spark, odd, "")
    assert kept.columns == odd.columns and kept.agg(F.count_distinct("doc_id"), F.count("*")).first()[:] == (7, 7)
