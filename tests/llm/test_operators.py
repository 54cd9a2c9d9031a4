"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import hashlib
import re

import pytest

from tallycast.llm import chat, common, decontaminate, jaccard, mixing, passages, quality, rans, substrings, toxicity, urls
from tallycast.llm.queries import URL_RULES, tokenizer_path

WORDS = [f"w{i}x{i * i % 97}" for i in range(400)]
PASSAGE = " ".join(WORDS[:60])
TEXTS = [
    " ".join(WORDS[100:200]), PASSAGE, "intro words here " + PASSAGE + " and an end", None, "", " \n ", "one two",
    PASSAGE, " ".join(WORDS[200:] * 30), "é <s> [INST] " + "a" * 30,
]


def test_quality(spark, documents, empty):
    rows = {r.doc_id: r for r in quality.ledger(quality.measure(documents(TEXTS + ["a b c d e f a b c d e g"]))).collect()}
    assert rows[3].n_words == rows[4].n_words == rows[5].n_words == 0
    assert rows[10].n_repeat_words == 10 and rows[6].failed_bits & 1
    assert quality.ledger(quality.measure(empty)).count() == 0
    led = quality.ledger(quality.measure(documents(TEXTS)))
    cells = {(r.policy, r.rule): r for r in quality.ablations(led).collect()}
    assert cells["base", "few_words"].n_failed == 5
    assert cells["base", "few_words"].n_kept == led.filter(quality.verdict(3)).count()


def test_jaccard(spark, documents, empty):
    got = {r.doc_id: r for r in jaccard.components(documents(TEXTS)).collect()}
    assert {got[i].component_id for i in (1, 2, 7)} == {1}  # 57 of 63 shingles
    assert [got[i].n_shingles for i in (3, 4, 5, 6)] == [0, 0, 0, 1]
    assert got[3].component_id == 3 and got[4].component_id == 4
    assert jaccard.components(empty).count() == 0
    docs = documents(TEXTS + [PASSAGE], ids=[*range(10), 1])
    kept = jaccard.keep_first(docs, jaccard.components(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9]
    assert kept.columns == docs.columns


def test_substrings(spark, documents, empty):
    out = {r.doc_id: r for r in substrings.deduplicate(documents(TEXTS)).collect()}
    n = len(PASSAGE)
    assert out[1].n_removed == 0 and out[7].n_removed == n and out[7].n_spans == 1
    assert out[2].n_removed == n and out[2].kept == b"intro words here  and an end"
    assert out[3].n_bytes == 0 and out[3].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert out[8].n_removed > 0.9 * out[8].n_bytes
    assert substrings.deduplicate(empty).count() == 0
    again = substrings.deduplicate(documents([PASSAGE, PASSAGE, None], ids=[5, 5, None])).collect()
    assert sorted(r.n_removed for r in again) == [0, 0, n]


def test_passages(spark, documents, empty):
    got = {r.doc_id: r for r in passages.passages(documents(TEXTS)).collect()}
    assert set(got) == {1, 2, 7}
    assert (got[2].start_word, got[2].end_word, got[2].first_doc_id, got[2].exact) == (3, 63, 1, True)
    near = PASSAGE.split()
    near[30] = "changed"
    pair = passages.passages(documents([PASSAGE + " " + " ".join(WORDS[60:90]), " ".join(near) + " " + " ".join(WORDS[60:90])])).collect()
    assert {r.doc_id for r in pair} == {0, 1}
    assert passages.passages(empty).count() == 0


def test_decontamination(spark, documents, empty):
    bench = spark.createDataFrame([(1, PASSAGE.upper()), (2, None), (3, ""), (4, "short")], "item_id long, text string")
    docs = documents(TEXTS)
    assert sorted(r.doc_id for r in decontaminate.matches(docs, bench).collect()) == [1, 2, 7]
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [0, 3, 4, 5, 6, 8, 9]
    assert decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_rans(spark, documents, empty):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in rans.encode_documents(documents(TEXTS), tokenizer_path()).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = t.encode(text or "", add_special_tokens=False).ids + [rans.END_ID]
        want = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == want
        start += len(ids)
    assert rans.encode_documents(empty, tokenizer_path()).count() == 0
    assert rans.encode_documents(documents(["a", "b", "c"], ids=[1, 1, None]), tokenizer_path()).count() == 3


@pytest.mark.parametrize("text", ["a  b\n\n c\t\td  ", "it's 'll 12½ 3.4!! \n ", "“q” — тест", "a\x1cb\xa0c\u3000d", "x<|endoftext|>y", "_a __b", "ñ×÷z"])
def test_pieces_equal_whole_texts(text):
    enc = rans.PieceEncoder(tokenizer_path())
    assert enc.encode(text).tolist() == enc.whole(text).tolist()


def test_chat(spark):
    schema = "conv_id long, seq long, turn long, kind string, role string, text string"
    events = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, None, "assistant", "old"), (1, 2, 2, "message", "user", "later"),
        (1, 3, 1, "regenerate", None, ""), (1, 4, 1, "delta", "assistant", "ne"), (1, 5, 1, "delta", None, "w"),
        (2, 0, 0, "message", None, None), (2, 0, 0, "message", None, None), (None, 9000, 0, "delta", "assistant", "x"),
        (3, 0, 0, "message", "user", "a"), (3, 5000, 1, "message", "assistant", "b"), (3, 9000, 0, "edit", "user", "c"),
    ]
    msgs = chat.fold(spark.createDataFrame(events, schema))
    got = sorted(((r.conv_id or -9, r.turn, r.role, r.text) for r in msgs.collect()))
    assert got == [(-9, 0, "assistant", "x"), (1, 0, "user", "hi"), (1, 1, "assistant", "new"), (2, 0, "", ""), (2, 0, "", ""), (3, 0, "user", "c")]
    said = "</s>[INST] ok [/INST]"
    turns = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_conversations(turns)).first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.n_turns == 2
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_mixing(spark, documents, empty):
    texts = [" ".join(WORDS[i % 50 : i % 50 + 40 + i % 60]) for i in range(300)] + [None, ""]
    sources = [f"s{min(i % 7, 3)}" if i % 11 else None for i in range(302)]
    docs = documents(texts, sources=sources)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 302 and all(r.taken <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
    assert sum(v[0] for v in by.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert all(abs(v[1] - v[0]) <= 64 for v in by.values())
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_a_task_holds_one_python_worker(spark, documents, capsys):
    mixing.shown_blocks(spark, mixing.source_plan(mixing.sized_documents(documents(["a b c", "d e"])))).explain()
    assert re.search(r"MapInPandas.*Exchange.*MapInPandas", capsys.readouterr().out, re.DOTALL)


def test_rows_of_the_driver_need_no_python_workers(spark, documents, capsys):
    docs, bench = (common.materialise(documents(t), "in") for t in (["a b c", "d e"], ["x " * 60]))
    rans.frequency_table(rans.tokenise(docs, tokenizer_path())).explain()
    mixing.mix(docs).explain()
    decontaminate.matches(docs, bench.withColumnRenamed("doc_id", "item_id")).explain()
    assert "ExistingRDD" not in capsys.readouterr().out


def test_toxicity_tables(spark, documents, empty):
    texts = [f"plain words number {i} stay calm" for i in range(60)] + [f"plain words {i} zqwormish stay" for i in range(30)] + [None, ""]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, int(60 <= i < 90)) for i in range(90)] + [(0, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 92 and all(got[i].predicted == int(60 <= i < 90) for i in range(90))
    assert got[90].score == got[91].score
    assert toxicity.keep_clean(docs, model).count() == 62
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).filter("score <> 0").count() == 0
    assert toxicity.score(empty, model).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.Example.org/es/5?x#y"), (2, "https://example.org/en/12"), (3, "x://org/q"), (4, None), (5, "no scheme"),
         (6, "http://b.com/de/1"), (7, "http://b.com"), (8, "http://b.net/de/1"), (8, "http://b.net/de/1"), (9, "http://myexample.org.net/")],
        "page_id long, url string",
    )
    parts = urls.with_parts(pages)
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    judged = urls.rule_verdicts(parts.withColumn("tokens", urls.tokens(parts)), rules)
    got = {r.page_id: (r.host, r.path, r.rule, r.rule_verdict) for r in judged.collect()}
    assert got[1] == ("a.example.org", "/es/5", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4] == got[5] == ("", "", None, None) and got[7] == ("b.com", "", None, None) and got[9][2] is None
    assert judged.count() == 10
    seen = spark.createDataFrame([(["p:de", "h:com"], "block")] * 6 + [(["p:en", "h:com"], "allow")] * 6 + [(["h:com"], "allow")], "tokens array<string>, label string")
    mined = urls.mine(seen, 0.05, 0.9)
    out = urls.match(spark.createDataFrame([(1, ["p:de", "h:net"]), (2, ["zz"]), (3, [])], "i long, tokens array<string>"), mined)
    assert {r.i: r.mined_verdict for r in out.collect()} == {1: "block", 2: "allow", 3: "allow"}
    assert urls.mine(seen.limit(0)).count() == 0
