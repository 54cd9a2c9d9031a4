"""The pipeline's stages on rows with clashing column names, repeated ids and null ids; mixing against its contract."""

import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallycast.llm import decontaminate, mixing, rans, toxicity
from tallycast.llm.queries import tokenizer_path

CLASHES = [
    "_tie", "_k", "_nth", "_all", "_bad", "_pass", "_n", "_d", "_s", "_t", "row", "tie", "hash", "of", "id", "pass", "part", "shown", "d",
    "s", "t", "n", "nth", "doc", "size", "target", "taken", "block", "counts", "ids", "score", "predicted",
]


@pytest.fixture
def clashing(documents):
    def make(texts, ids, sources=None):
        docs = documents(texts, ids, sources).select("doc_id", "text", "lang", "source", "n_chars")
        for i, c in enumerate(CLASHES):
            docs = docs.withColumn(c, F.lit(i))
        return docs.withColumn("a.b", F.lit("dot"))

    return make


def untouched(rows):
    return all([r[c] for c in CLASHES] == list(range(len(CLASHES))) and r["a.b"] == "dot" for r in rows)


ITEM = " ".join(f"item{i} question word" for i in range(30))
TEXTS = [f"plain text number {i} " * 12 for i in range(30)] + [f"before {ITEM} after", ITEM, "", None, "plain text"]
IDS = [1] * 20 + [None] * 6 + list(range(100, 104)) + [1, None, 1, None, 7]


def test_decontaminate_judges_rows_under_any_names(spark, clashing):
    docs = clashing(TEXTS, IDS)
    benchmark = spark.createDataFrame([(None, ITEM), (2, None), (3, "")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert untouched(rows)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t in zip(IDS, TEXTS) if "item0" not in (t or ""))


def test_keep_clean_under_any_names(spark, clashing):
    docs = clashing(TEXTS, IDS)
    labels = spark.createDataFrame([(1, 0), (7, 0)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) and untouched(kept.collect())


def test_mixing_under_any_names(spark, clashing):
    sources = [f"s{i % 3}" for i in range(len(TEXTS) - 1)] + [None]
    docs = clashing(TEXTS, IDS, sources)
    out = mixing.mixed_documents(docs, block_words=8, shard_slots=16)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and untouched(rows)
    given = {t for t in TEXTS if t}
    for r in rows:
        assert r.n_chars == len(r.text) and r.text
        assert any(r.text in t or set(r.text.split()) <= set(t.split()) for t in given)


@pytest.mark.parametrize("drawn", [4096, 3])
def test_mixing_against_its_contract(spark, documents, monkeypatch, drawn):
    monkeypatch.setattr(mixing, "DRAWN_SHARDS", drawn)
    texts = [" ".join(f"w{i}x{j}" for j in range(i % 53)) for i in range(400)] + [None, "", "a b"]
    ids = [5] * 130 + [None] * 30 + list(range(1000, 1000 + len(texts) - 160))
    sources = [["b", "a", "c", "d", None][min(4, i % 9 // 2)] for i in range(len(texts))]
    docs = documents(texts, ids, sources)
    options = {"block_words": 8, "shard_slots": 64}
    rows = mixing.mix(docs, **options).collect()
    size = Counter()
    for t, s in zip(texts, sources):
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.water_fill([size[s] for s in order], [5.0, 2.0, 1.0, 5.0, 2.0])))
    assert sum(targets.values()) == pytest.approx(sum(size.values()))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len((t or "").split())) for i, t in zip(ids, texts))
    taken = Counter()
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        assert sum(x.words * x.times for x in r.shown or []) == r.taken
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - targets[s]) <= max(16, 0.02 * targets[s])
    again = mixing.mix(docs.repartition(7), **options).collect()
    assert Counter((r.doc_id, r.tie, r.taken) for r in again) == Counter((r.doc_id, r.tie, r.taken) for r in rows)


def test_token_counts_from_the_coding_pass(spark, documents):
    docs = documents(["the cat sat", "the the", None, "x" * 50], ids=[1, 1, None, 2])
    tokens = rans._tokens(docs, tokenizer_path(), 2).cache()
    from_counts = {r.token: r.frequency for r in rans.frequency_table(tokens).collect()}
    from_ids = {r.token: r.frequency for r in rans.frequency_table(rans.tokenise(docs, tokenizer_path())).collect()}
    assert from_counts == from_ids and from_ids
    rows = rans.encode_documents(docs, tokenizer_path()).collect()
    assert sorted(r.n_tokens for r in rows)[0] == 1 and [r.start for r in rows if r.doc_id is None] == [0]


def test_the_pipeline_hands_texts_over_in_small_batches(spark, tmp_path, documents, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, sizes = spark.conf.get(key), "n long"
    documents(["word"] * 5_000, list(range(5_000))).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def batches(spark, docs, sf_dir):
        return docs.coalesce(1).mapInPandas(lambda pdfs: (pd.DataFrame({"n": [len(p)]}) for p in pdfs), sizes)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("batches", batches)])
    got = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(got) == 5_000 and max(got) <= 2_000 and spark.conf.get(key) == before
    spark.conf.set(key, "700")  # the caller's own stands
    try:
        assert max(r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) <= 700 and spark.conf.get(key) == "700"
    finally:
        spark.conf.set(key, before)
