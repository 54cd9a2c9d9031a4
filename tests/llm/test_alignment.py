"""Cross-tokenizer alignment against a brute force over byte ranges."""

import functools
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallycast.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "the cat  sat\n on <s> the <|endoftext|> mat\t", "naïve ﬁancé Ⅷ 漢字 😀", "with ▁ sign", "x\x00y",
    "the cat sat", "the cat sat", "ab" * 400, "é" * 300 + " " * 40 + "end ", "the mat, the cat; don't we'll 123 4567",
]


@pytest.fixture(scope="module")
def side_b():
    return alignment.PieceSide(B)


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B), alignment.ByteSide(A).bytes


@functools.cache
def tokens_of(text):
    """Ids and bytes of both sides straight from the libraries; none where a side does not give the text back."""
    if not text:
        return [], []
    t, sp, side = libraries()
    a = [(i, side[i]) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    ok = b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want
    return (a, b) if ok else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts):
    docs = []
    for text in texts:
        a, b = map(spans, tokens_of(text))
        links = [(x[0], y[0]) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2])]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [
            ",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi)
            for lo, hi in zip([0, *cuts], cuts)
        ]
        docs.append((len(a), len(b), groups, links))
    held = Counter(p for d in docs for p in set(d[3]))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return [
        (
            na, nb, len(g), len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls),
            hashlib.sha256(";".join(g).encode()).hexdigest() if g else "",
        )
        for na, nb, g, ls in docs
    ]


def test_digest_against_brute_force(spark, documents):
    got = {r[0]: tuple(r[1:]) for r in alignment.digest(documents(TEXTS).repartition(3), A, B).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS)
    assert sum(1 for t in got.values() if t[0] == 0) == 3  # null, empty and the one with the space sign


def test_small_chunks_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 20)
    got = {r[0]: tuple(r[1:]) for r in alignment.digest(documents(TEXTS).coalesce(1), A, B).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS)


def test_repeated_and_null_ids_are_rows_of_their_own(spark, documents):
    rows = alignment.digest(documents(["the cat", "the cat", "a dog"], ids=[5, 5, None]), A, B).collect()
    assert sorted((r.doc_id is None, r.n_a > 0, r.count_sum) for r in rows) == [(False, True, 4), (False, True, 4), (True, True, 2)]


def test_empty_table(empty):
    assert alignment.digest(empty, A, B).count() == 0
    assert alignment.align(empty, A, B).count() == 0


def test_align_gives_tokens_and_group_ends(spark, documents):
    rows = {r.doc_id: r for r in alignment.align(documents(TEXTS), A, B).collect()}
    for i, text in enumerate(TEXTS):
        a, b = tokens_of(text)
        assert (rows[i].a_ids, rows[i].b_ids) == ([x for x, _ in a], [x for x, _ in b])
        for ea, eb in zip(rows[i].a_ends, rows[i].b_ends, strict=True):
            assert b"".join(x for _, x in a[:ea]) == b"".join(x for _, x in b[:eb])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=60), st.lists(st.integers(0, 300), max_size=60), st.randoms())
def test_gallop_is_a_lower_bound(keys, into, rnd):
    keys, into = np.sort(np.array(keys, np.int64)), np.sort(np.array(into, np.int64))
    start = np.array([rnd.randrange(-5, 70) for _ in keys], np.int64)
    assert alignment.gallop(keys, into, start).tolist() == np.searchsorted(into, keys).tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ab\n\t<>s/éß漢😀▁ﬁ0"), max_size=40))
def test_units_equal_whole_texts(side_b, text):
    if "▁" not in text:
        assert side_b.units and side_b.encode(text).tolist() == side_b.model.encode(text)
