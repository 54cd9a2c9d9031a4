"""Language identification: counts and scores against plain Python, and held-out accuracy."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallycast.llm import language
from tallycast.llm import queries as Q

TEXTS = [
    ("en", "The cat and the dog, the house."), ("en", "A house; a DOG and cats 12"), ("fr", "Le chat et le chien"),
    ("fr", "la maison et le jardin"), ("de", "Der Hund und das Haus"), (None, "nobody knows"), ("en", None), ("de", ""),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "lang string, text string")


def brute(labelled, text, smoothing=language.SMOOTHING, orders=language.ORDERS):
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for lang, t in labelled:
        if lang is not None and t is not None:
            for w in language.words_of(t):
                words[lang][w] += 1
                for o in range(1, orders + 1):
                    marked = f"<{w}>" if o > 1 else w
                    for i in range(len(marked) - o + 1):
                        grams[lang][marked[i : i + o]] += 1
    langs = sorted(words)
    found = language.words_of(text or "")
    if not found or not langs:
        return "und", 0.0

    def log(counts, key, same):
        n = sum(v for k, v in counts.items() if same(k))
        kinds = sum(1 for k in counts if same(k))
        return math.log((counts[key] + smoothing) / (n + smoothing * (kinds + 1)))

    total = dict.fromkeys(langs, 0.0)
    for w in found:
        if any(w in words[lang] for lang in langs):
            for lang in langs:
                total[lang] += log(words[lang], w, lambda k: True)
            continue
        for o in range(orders, 0, -1):
            marked = f"<{w}>" if o > 1 else w
            known = [g for g in (marked[i : i + o] for i in range(len(marked) - o + 1)) if any(g in grams[x] for x in langs)]
            if known:
                for lang in langs:
                    total[lang] += sum(log(grams[lang], g, lambda k, o=o: len(k) == o) for g in known) / len(known)
                break
    best = max(langs, key=lambda lang: total[lang])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_scores_against_plain_python(spark, texts, documents):
    asked = ["the cat", "chiens et chats", "Hundehaus", "xyzzy", "漢字", "½ 12", "", None, "catty the maisonette und", "the cat"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents(asked), language.train(texts)).collect()}
    labelled = [t for t in TEXTS if not (t[0] == "de" and t[1] == "")]
    for i, t in enumerate(asked):
        lang, score = brute(labelled, t)
        assert got[i][0] == lang, t
        assert got[i][1] == pytest.approx(score, rel=1e-9)


def test_counts_cover_every_text_whatever_the_flush(spark, texts, monkeypatch):
    want = Counter()
    for lang, t in TEXTS:
        if lang is not None and t is not None:
            want.update((lang, w) for w in language.words_of(t))
    monkeypatch.setattr(language, "FLUSH_ROWS", 3)
    got = {(r.lang, r.word): r.n for r in language.word_counts(texts).collect()}
    assert got == dict(want)


def test_model_size_is_bounded_and_the_rest_backs_off(spark, texts):
    model = language.train(texts, model_rows=6)
    assert len(model.words) <= 6 and len(model.grams) <= 6
    assert language.Scorer(model).predict("the the the")[0] in model.langs
    counts = spark.createDataFrame([("a", "x", 5), ("a", "y", 5), ("b", "x", 7), ("b", "z", 5000)], "lang string, word string, n long")
    assert [language.frequent(counts, k).count() for k in (0, 1, 2, 3, 4)] == [0, 1, 2, 2, 4]


def test_nothing_learned_and_empty_tables(spark, documents, empty):
    model = language.train(spark.createDataFrame([(None, "a b")], "lang string, text string"))
    assert [tuple(r) for r in language.identify(documents(["a b"], [3]), model).collect()] == [(3, "und", 0.0)]
    assert language.identify(empty, model).count() == 0


def test_ties_go_to_the_smallest_name_and_repeated_rows_agree(spark, documents):
    model = language.train(spark.createDataFrame([("y", "one two"), ("x", "one two")], "lang string, text string"))
    rows = language.identify(documents(["one", "one", "unseen"], [1, 1, None]), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("x", 0.5)}


def test_cache_resets_do_not_change_scores(spark, texts, monkeypatch):
    model = language.train(texts)
    text = " ".join(f"catword{chr(97 + i % 26)}{chr(97 + i // 26)} maison" for i in range(300))
    want = language.Scorer(model).predict(text)
    monkeypatch.setattr(language, "CACHE_WORDS", 10)
    got = language.Scorer(model).predict(text)
    assert got[0] == want[0] and got[1] == pytest.approx(want[1])


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    found = Q.op13_language_id(spark, base).filter("held_out")
    told = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "lang")
    right = found.join(told, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
