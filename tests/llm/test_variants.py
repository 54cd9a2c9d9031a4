"""Spelling variants against a brute force over all word pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallycast.llm import variants


def brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}

    def near(x, y):
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        x, y = sorted((x, y), key=len)
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    out = {}
    for w in n:
        around = [v for v in n if near(w, v)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = [form, w, n[w], len(around), n[form] if form else None]
    for w in n:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(v) for w, v in out.items()}


def corpus(seed, rows=120):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abÀéz÷") for _ in range(rnd.choice([6, 7, 8, 9]))) for _ in range(25)]
    base += ["y" * 80, "y" * 81, "y" * 79 + "z", "Receive", "recieve", "receiveé"]
    texts = []
    for _ in range(rows):
        words = []
        for _ in range(rnd.randrange(0, 60)):
            w = base[min(int(rnd.expovariate(0.25)), len(base) - 1)]
            if rnd.random() < 0.1:
                i = rnd.randrange(len(w))
                w = w[:i] + rnd.choice(["", "a", "Z", "ÿ"]) + w[i + rnd.randrange(2) :]
            words.append(w if rnd.random() < 0.8 else w.upper())
        texts.append(rnd.choice([" ", "-", "1 "]).join(words))
    return texts + [None, "", "aaaaaaa aaaaaaa aaaaaab aaaaaab", texts[0]]


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, documents, seed):
    texts = corpus(seed)
    ids = [None if i % 17 == 0 else i // 2 for i in range(len(texts))]
    want = brute(list(zip(ids, texts)))
    assert sum(v[0] is not None for v in want.values()) > 3
    assert result(variants.group_variants(documents(texts, ids))) == want


def test_a_filter_at_its_limit_changes_nothing(spark, documents):
    texts = corpus(3, 60)
    assert result(variants.group_variants(documents(texts), limit=8192)) == brute(list(enumerate(texts)))


def test_forms_are_followed_to_the_root(spark, documents):
    # no deletion rule falls on these: the counts below are the test's own check
    texts = ["abcdefgh " * 400 + "abcdefgx " * 30 + "abcdefyx " * 2]
    got, want = result(variants.group_variants(documents(texts, [7]))), brute([(7, texts[0])])
    assert got == want
    assert got["abcdefyx"][:2] == ("abcdefgx", "abcdefgh")


def test_empty_and_wordless(spark, documents, empty):
    assert variants.group_variants(empty).count() == 0
    assert variants.group_variants(documents(["", None, "short words only", "singular"])).count() == 0


def test_very_long_run(spark, documents):
    long = "q" * 20_000
    got = result(variants.group_variants(documents([f"{long} {long}", f"{long}x {long}x", f"{long} {long}x"])))
    assert {len(w): v[2:4] for w, v in got.items() if len(w) in (20_000, 20_001)} == {20_000: (3, 1), 20_001: (3, 1)}


def test_filters_have_no_false_negatives_and_few_positives():
    rnd = np.random.default_rng(0)
    words = ["".join(map(chr, rnd.choice(variants.ALPHABET, 9))) for _ in range(4000)]
    keys = variants.word_keys(words)
    f = variants.Filters.sized({9: 2000})
    f.lanes = np.zeros((int(f.first[-1]), 8), np.uint32)
    for lane in range(8):
        np.bitwise_or.at(f.lanes[:, lane], f.block_of(9, keys[:2000]), np.uint32(1) << f.bit(keys[:2000], lane).astype(np.uint32))
    assert f.maybe(9, keys[:2000]).tolist() == list(range(2000))
    assert len(f.maybe(9, keys[2000:])) < 40
    assert len(f.maybe(8, keys)) == 0


def test_edit_keys_are_those_of_the_edited_words():
    words = ["abcdéfg", "zzzzzzz"]
    codes = variants.matrix(words)
    for j, w in enumerate(words):
        cut = [w[:i] + w[i + 1 :] for i in range(len(w))]
        assert variants.deletions(codes)[j].tolist() == variants.word_keys(cut).tolist()
    for letter, (row, key) in zip(variants.ALPHABET, variants.replacements(codes)):
        want = [w[:i] + chr(letter) + w[i + 1 :] for w in words for i in range(7) if ord(w[i]) < letter]
        assert key.tolist() == (variants.word_keys(want).tolist() if want else [])
