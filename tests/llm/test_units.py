"""Pure pieces against brute force."""

import random
import weakref
import zlib

import numpy as np
import pytest

from tallycast.llm import chat, common, decontaminate, hashing, mixing, passages, rans, substrings, toxicity
from tallycast.llm.queries import tokenizer_path
from tallycast.llm.suffixes import suffix_array


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(800):
        k = rng.choice([1, 2, 3, 8])
        s = [rng.randrange(1, k + 1) for _ in range(rng.randrange(40))]
        s = (s[:5] * 10)[: len(s)] + [0] if rng.random() < 0.3 else s + [0]
        assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_word_hashes_agree_with_words():
    a = hashing.word_hashes(b"one two  one\ttwo\none")
    assert len(a) == 5 and a[0] == a[2] == a[4] and a[1] == a[3] != a[0]
    long = b"word " * 300 + b"x" * 5000 + b" end"
    assert (hashing.word_hashes(long) == hashing.word_hashes(long, 64)).all()


def test_coder_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, rans.LANES - 1, rans.LANES + 1, 300 * rans.LANES + 7):
        ids = np.minimum(rng.geometric(0.01, n), 900).astype(np.uint32)
        tokens, counts = np.unique(ids, return_counts=True)
        coder = rans.Coder(tokens.astype(np.int64), rans.scale_counts(counts))
        states, words, marks, snaps = coder.encode(ids)
        assert (coder.decode(n, states, words) == ids).all()
        assert (coder.decode_from_checkpoints(n, states, words, marks, snaps) == ids).all()


def test_permute_is_a_permutation():
    for n in (1, 2, 3, 17, 1000):
        j = np.arange(n)
        assert sorted(mixing.permute(j, np.full(n, n), np.full(n, 5)).tolist()) == j.tolist()


def test_water_fill():
    assert mixing.water_fill([10, 10], [5, 1]) == pytest.approx([20 * 5 / 6, 20 / 6])
    assert mixing.water_fill([1, 99], [5, 2]) == pytest.approx([3, 97])
    assert mixing.water_fill([0, 0], [5, 2]) == [0, 0]
    draws = mixing.draw_shards([5, 0, 700], shard_slots=100)
    assert sum(c for _, s, _, c in draws if s == 0) == 5 and sum(c for _, s, _, c in draws if s == 2) == 700


def test_escape_round_trip():
    rng = random.Random(2)
    parts = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<SYS>>", "</SYS>>", "a", "\n"]
    import re

    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        escaped = re.sub(chat.ESCAPE, r"\1\\\2\3", text)
        assert not re.search(r"</?s>|\[/?INST\]", escaped)
        assert chat.unescape(escaped) == text


def _edits(seg, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(seg):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_index_finds_what_brute_force_finds():
    rng = random.Random(4)
    letters = "abcdefghij "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([30, 64, 90, 150])))) for i in range(12)]
    index = decontaminate.Index(items)
    for _ in range(60):
        i, t = rng.choice(items)
        seg = list(decontaminate.normalise(t))
        for _ in range(rng.randrange(10)):
            p = rng.randrange(len(seg))
            seg[p : p + 1] = rng.choice([[], [rng.choice(letters)], [seg[p], rng.choice(letters)]])
        text = decontaminate.normalise("".join(rng.choice(letters) for _ in range(50)) + "".join(seg) + " tail")
        n = decontaminate.normalise(t)
        m = min(decontaminate.SEGMENT, len(n))
        starts = {*range(0, len(n) - m + 1, decontaminate.SEGMENT // 2), len(n) - m}
        want = any(_edits(n[s : s + m], text) <= decontaminate.edit_budget(m) for s in starts)
        assert want == (i in {x[0] for x in index.match(text)})
    assert index.match("") == [] and decontaminate.Index([]).match("some text that is long enough") == []


def test_compact_windows_against_definition():
    rng = np.random.default_rng(5)
    s = rng.integers(0, 30, 160).astype(np.uint64)
    h, _ = passages._centres(s, 0)
    rank = [(int(h[i] >> np.uint64(32)), -i) for i in range(len(s))]
    want = set()
    for c in range(len(s)):
        lo = c
        while lo and rank[lo - 1] > rank[c]:
            lo -= 1
        hi = c
        while hi + 1 < len(s) and rank[hi + 1] > rank[c]:
            hi += 1
        if hi - lo + 1 >= passages.WIDTH:
            want.add((lo, c, hi))
    assert set(passages.compact_windows(s, 0)) == want


def test_runs_cover_every_window_and_follow_content():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 101, 900).astype(np.uint8)
    h, p, a, b, c = substrings.runs(data)
    assert a[0] == 0 and b[-1] == len(data) - substrings.LENGTH and (a[1:] == b[:-1] + 1).all()
    assert ((p >= b) & (p - a < substrings.STARTS)).all()
    assert len(substrings.runs(data[:50])[0]) == 0


def test_toxicity_learns_a_word_and_its_misspelling():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(300)]
    text = lambda extra: " ".join(rng.choices(words, k=20) + extra)
    texts = [text(["zqwormish"]) for _ in range(60)] + [text([]) for _ in range(200)]
    y = np.array([1] * 60 + [0] * 200)
    scorer = toxicity.Scorer(toxicity.train(texts, y, np.ones(260)))
    assert scorer.score(text(["zqwormish"])) > 0.5 and scorer.score(text(["zqwormixh"])) > scorer.score(text([]))
    assert 0 <= scorer.score("") < 0.5
    assert toxicity.Scorer(toxicity.train([], np.zeros(0, int), np.zeros(0))).score("x") == 0.0


def test_a_worker_holds_the_caches_of_one_operator():
    common.worker_state("a")["x"] = 1
    assert common.worker_state("a") == {"x": 1}
    assert common.worker_state("b") == {} == common.worker_state("a")


def test_a_tokenizer_is_freed_as_soon_as_another_operator_asks():
    enc = common.worker_state("rans").setdefault("x", rans.PieceEncoder(tokenizer_path()))
    enc, held = None, weakref.ref(enc)  # its cache refers to it, so only a collection finds it
    assert held() is not None
    common.worker_state("b")
    assert held() is None


def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    ran = common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(ran) == 2 and not given
    assert list(ran) == [3] and given == [1]


def test_coder_looks_states_up_by_plain_indices():
    coder = rans.Coder(np.array([3, 5]), np.array([7, 9]))
    assert coder.slot.dtype == np.intp  # take converts others anew in every row
    ids = np.array([3, 5, 5] * 3000, dtype=np.uint32)
    states, words, marks, snaps = coder.encode(ids)
    got = coder.decode_from_checkpoints(len(ids), states, words, marks, snaps)
    assert got.dtype == np.uint32 and got.tolist() == ids.tolist()


def test_pieces_are_looked_up_once_and_encoded_where_missing(monkeypatch):
    monkeypatch.setattr(rans, "CACHE_PIECES", 3)
    enc = rans.PieceEncoder(tokenizer_path())
    assert enc.cache[" abc"] == enc._piece(" abc") and list(enc.cache) == [" abc"]
    encoded = []
    monkeypatch.setattr(enc, "model", type("Model", (), {"tokenize": lambda _, w, t=enc.model.tokenize: encoded.append(w) or t(w)})())
    for text in ("ab cd ef ab cd ef gh", "ab cd", "ab xy", "cd ef xy"):
        assert enc.encode(text).tolist() == enc.whole(text).tolist()
    assert len(encoded) == len(set(encoded))


def test_an_encoder_may_remember_fewer_pieces():
    enc = rans.PieceEncoder(tokenizer_path())
    enc.most = 2
    for text in ("ab cd ef", "gh ij kl", "ab cd ef mn"):
        assert enc.encode(text).tolist() == enc.whole(text).tolist()
    assert len(enc.cache) + len(enc.old) == 7


def test_ids_stay_in_two_bytes_from_the_pieces_to_the_file():
    enc = rans.PieceEncoder(tokenizer_path())
    ids = enc.ids("two words, 3 numbers\n")
    assert ids.dtype == np.uint16 and ids.tolist() == enc.whole("two words, 3 numbers\n").tolist()
    for said in (ids, enc.ids(""), enc.ids("中文")):
        for end in (rans.END_ID, 1 << 17):
            ended = rans._ended(said, end)
            assert ended.tolist() == [*said.tolist(), end] == rans._unpack(rans._pack(ended)).tolist()
            assert rans._crc(ended) == zlib.crc32(np.array(ended, "<u4").tobytes())
