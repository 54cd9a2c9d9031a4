"""Cases in which a part of the job was once left out."""

import time

import numpy as np

import corpus_pipeline
from tallycast.llm import decontaminate, jaccard, mixing, passages

WORDS = [f"w{i}x{i * i % 97}" for i in range(4000)]


def text(*parts):
    return " ".join(" ".join(WORDS[a:b]) for a, b in parts)


def rows_of(df):
    return {(r.doc_id, r.first_doc_id): (r.start_word, r.end_word) for r in df.collect()}


def test_passages_of_several_classes_stay_apart(documents):
    texts = [text((0, 70), (200, 240)), text((300, 340), (100, 170)), text((0, 70), (100, 170))]
    got = rows_of(passages.passages(documents(texts, ids=[1, 5, 9])))
    want = {(1, 1): (0, 70), (9, 1): (0, 70), (5, 5): (40, 110), (9, 5): (70, 140)}
    assert set(got) == set(want)
    for k, (lo, hi) in want.items():  # near subsequences reach at most five words further
        assert lo - 5 <= got[k][0] <= lo and hi <= got[k][1] <= hi + 5


def test_decontamination_judges_rows_not_ids(spark, documents):
    bench = spark.createDataFrame([(None, text((0, 30))), (3, text((100, 130)))], "item_id long, text string")
    texts = [text((0, 40)), text((200, 240)), text((90, 140)), text((300, 340)), text((400, 440))]
    docs = documents(texts, ids=[None, None, 7, 7, 8])
    assert sorted(r.text for r in decontaminate.decontaminate(docs, bench).collect()) == sorted(texts[i] for i in (1, 3, 4))
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert found == {(None, None), (7, 3)}


def test_small_sources_reach_their_targets(documents):
    sizes = {"s0": 5, "s1": 10, "s2": 100, "s3": 3000, "s4": 9000}
    docs = documents([text((0, n)) if n <= 4000 else text((0, 4000), (0, 4000), (0, 1000)) for n in sizes.values()], sources=list(sizes))
    rows = {r.source: r for r in mixing.mix(docs).collect()}
    for s in ("s0", "s1"):
        assert rows[s].target == rows[s].taken == 3 * sizes[s]
    assert all(abs(r.taken - r.target) <= 64 for r in rows.values())


def test_pipeline_links_five_words_at_80_percent(spark, documents):
    # 97 of 118 4-word shingles and 96 of 117 5-word ones are shared: 0.82, under the 85 percent of op4
    docs = documents([text((0, 100)), text((0, 100), (200, 221)), text((1000, 1100))])
    assert [r.doc_id for r in corpus_pipeline.one_per_group(spark, docs, "").orderBy("doc_id").collect()] == [0, 2]
    assert len({r.component_id for r in jaccard.components(docs).collect()}) == 3


def test_near_passages_with_exact_copies_are_linked(documents):
    a = WORDS[:90]
    b = [*a[:45], "changed", *a[46:]]
    texts = [
        " ".join([*WORDS[900 * k + 200 : 900 * k + 260], *p, *WORDS[900 * k + 300 : 900 * k + 360]])
        for k, p in enumerate((a, a, b, b))
    ]
    rows = passages.passages(documents(texts, ids=[1, 2, 3, 4])).collect()
    assert any(r.doc_id in (3, 4) and r.first_doc_id in (1, 2) for r in rows)


def _frames(seqs):
    """Inputs of passages.solve for the runs of some documents, under every function."""
    out = []
    for d, s in enumerate(seqs):
        padded = np.concatenate([np.zeros(passages.WIDTH, np.uint64), s, np.zeros(passages.WIDTH, np.uint64)])
        for f in range(passages.FUNCTIONS):
            v, c, a, b, run = passages._runs(s, f)
            for i in range(len(v)):
                frame = (padded[c[i] + 1 : c[i] + 1 + passages.FRAME] >> np.uint64(32)).astype(np.uint32)
                out.append((v[i].view(np.int64), run[i].view(np.int64), d, c[i], a[i], b[i], frame))
    v, run, doc, at, lo, hi, frame = (np.array(x) for x in zip(*out, strict=True))
    return v, v, run, doc, doc, at, lo, hi, frame


def test_near_passages_against_brute_force():
    rng = np.random.default_rng(11)
    pairs, seqs = 150, []
    for k in range(pairs):  # one passage of 50 words, one word changed, in two otherwise different documents
        words = rng.integers(0, 1 << 40, 50)
        for copy in range(2):
            p = words.copy()
            p[24] += copy
            seqs.append(passages.sequence(" ".join(map(str, [*rng.integers(0, 1 << 40, 70), *p, *rng.integers(0, 1 << 40, 70)]))))
    got = passages.solve(*_frames(seqs))
    linked = {f for f in got["first"][got["doc"] != got["first"]]}
    assert linked <= {2 * k for k in range(pairs)}
    assert len(linked) >= 0.97 * pairs
    assert set(got["lo"] + got["begin"]) == set(got["lo"] + got["end"]) == {70}


def test_verified_places_against_sets():
    rng = np.random.default_rng(12)
    x = np.stack([rng.permutation(500)[: passages.FRAME] for _ in range(200)]).astype(np.uint64)
    y = x.copy()
    for row in y:
        at = rng.integers(0, passages.FRAME, rng.integers(0, 16))
        row[at] = rng.integers(500, 5000) + np.arange(len(at))
    y[100:] = np.roll(y[100:], 1, axis=1)
    got = passages._near_distinct(x, y)
    assert (got == passages._near_sets(x, y)).all() and 0 < got.sum() < got.size
    for i in (0, 7, 150):
        for f in range(passages.WIDTH):
            p, q = set(x[i, f : f + passages.WIDTH].tolist()), set(y[i, f : f + passages.WIDTH].tolist())
            assert got[i, f] == (100 * len(p & q) >= 80 * len(p | q))


def test_passages_are_found_at_all_places_of_a_repeated_section(documents):
    section = text((0, 200))
    texts = [f"{section} {text((300, 340))} {section}", f"{text((400, 440))} {text((60, 120))} {text((500, 540))}"]
    got = {}
    for r in passages.passages(documents(texts[:2], ids=[4, 6])).collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    assert len(got[4]) == 2 and len(got[6]) == 1
    for begin, end in got[4]:
        assert any(0 <= p + 60 - begin <= 5 and 0 <= end - p - 120 <= 5 for p in (0, 240))
    rows = passages.passages(documents([texts[1], f"{text((600, 700))} {section}"] * 2, ids=[6, 7, None, None])).collect()
    assert {r.doc_id < passages.NO_ID for r in rows} == {True, False}
    assert len({r.doc_id for r in rows}) == 4 and {r.first_doc_id for r in rows if r.doc_id >= passages.NO_ID} >= {6, 7}


def test_repeated_and_long_benchmark_items(spark, documents, monkeypatch):
    long = decontaminate.normalise(text((0, 400)))
    monkeypatch.setattr(decontaminate, "PIECE_CHARS", 512)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)

    def starts(t):
        return {t[s : s + 64] for s in (*range(0, len(t) - 63, 32), len(t) - 64)}

    for n in (64, 100, 575, 576, 577, 1100, len(long)):
        cut = decontaminate.pieces(long[:n])
        assert set().union(*map(starts, cut)) == starts(long[:n]) and max(map(len, cut)) < 512 + 64
    rows = [(i, text((500, 530))) for i in range(200)] + [(None, text((500, 530))), (900, long), (901, text((600, 630)))]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    sizes = [sum(len(t) for _, t in b) for b in decontaminate.blocks(decontaminate.distinct_pieces(decontaminate._items(bench)))]
    assert max(sizes) < 4 * 2000
    docs = documents([text((490, 540)), text((0, 410)), text((0, 410)), text((700, 800))], ids=[1, 2, 2, 3])
    got = decontaminate.matches(docs, bench).collect()
    assert sorted(r.item_id for r in got if r.doc_id == 1 and r.item_id is not None) == list(range(200))
    assert sum(r.item_id is None for r in got) == 1
    whole = [r for r in got if r.doc_id == 2]
    assert [(r.item_id, r.edits, r.start, r.end) for r in whole] == [(900, 0, 0, len(long))] * 2
    assert whole[0].segments == len(starts(long))


def test_passages_do_not_depend_on_where_a_group_is_solved(documents, monkeypatch):
    """Groups over HOT_RUNS, in pieces, give the rows that small ones give."""
    rng = np.random.default_rng(3)
    texts = []
    for k in range(3):
        base = rng.integers(0, 1 << 40, 90).astype(str).tolist()
        kinds = [base, [*base[:45], "changed", *base[46:]], [*base[:20], "put", *base[21:]], [*base[:60], *base[60:64], *base[40:66]]]
        for copies, p in zip((2, 2, 1, 1), kinds, strict=True):
            for _ in range(copies):
                texts.append(" ".join([*rng.integers(0, 1 << 40, 30).astype(str), *p, *rng.integers(0, 1 << 40, 30).astype(str)]))
    docs = documents(texts, ids=list(rng.permutation(len(texts)).tolist()))
    small = sorted(map(tuple, passages.passages(docs).collect()))
    monkeypatch.setattr(passages, "HOT_RUNS", 1)
    monkeypatch.setattr(passages, "PIECE", 2, raising=False)
    hot = sorted(map(tuple, passages.passages(docs).collect()))
    assert hot == small and len({r[0] for r in small}) > 10


def test_large_groups_with_repeated_shingles_are_compared_by_matrices(monkeypatch):
    """Frames of few different shingles, as brute force pairs them, in a number of pair comparisons that does not grow with the pairs."""
    rng = np.random.default_rng(5)
    n, w, frames = 90, passages.WIDTH, passages.FRAME
    frame = np.stack([np.resize(rng.integers(0, 9, rng.integers(2, 8)), frames) for _ in range(n)]).astype(np.uint32)
    frame[::3, 70:] = rng.integers(100, 100_000, (len(frame[::3]), frames - 70))
    begin = rng.integers(0, w - 8, n)
    f = np.arange(w)
    own = (f >= begin[:, None]) & (f < begin[:, None] + 8)
    zeros, number = np.zeros(n, np.int64), np.arange(n)
    plain, compared = passages._near_sets, []
    monkeypatch.setattr(passages, "_near_sets", lambda x, *more: compared.append(len(x)) or plain(x, *more))
    x, y, k = passages._near_pairs(zeros, zeros, number, number, number, frame, own)
    assert sum(compared) < n  # all of the n * (n - 1) / 2 pairs before
    sets = [[set(r[i : i + w].tolist()) for i in f] for r in frame]
    a, b, g = [], [], []
    for i in range(n):
        for j in range(i):
            for at in np.flatnonzero(own[i] & own[j]):
                p, q = sets[i][at], sets[j][at]
                if 100 * len(p & q) >= 80 * len(p | q):
                    a, b, g = [*a, i], [*b, j], [*g, at]
    a, b, g = (np.array(v, np.int64) for v in (a, b, g))
    want = passages._roots(a * w + g, b * w + g, n * w)
    assert (passages._roots(x * w + k, y * w + k, n * w) == want).all() and 20 < len(np.unique(want[own.ravel()])) < own.sum()


def test_all_windows_of_a_group_are_compared():
    """Classes are those of brute force over all windows: also around exact repeats, and through windows of one document."""
    rng = np.random.default_rng(8)

    def words(n):
        return rng.integers(0, 1 << 40, n).tolist()

    seqs = []
    for _ in range(12):
        base = words(100)
        changed, both, put = list(base), list(base), list(base)
        changed[20] = both[20] = words(1)[0]
        both[75] = words(1)[0]
        put.insert(60, words(1)[0])
        for p in ([*base, *words(30), *changed], changed, both, put, base[:80], base[15:], [*base[:50], *base[46:50] * 12, *base[50:]]):
            seqs.append(passages.sequence(" ".join(map(str, [*words(30), *p, *words(30)]))))
    args = _frames(seqs)
    group, value, run, doc, last, at, lo, hi, frame = args
    got = {}
    for r in passages.solve(*args).itertuples():
        got |= {(r.value, r.doc, r.lo + i): r.first for i in range(r.begin, r.end + 1)}
    windows = {}
    for i, g in enumerate(value):
        for start in range(lo[i], hi[i] + 1):
            f = start - at[i] + passages.WIDTH - 1
            windows.setdefault((g, f), []).append((doc[i], start, set(frame[i, f : f + passages.WIDTH].tolist())))
    want = {}
    for (g, _), held in windows.items():
        a, b = np.array([(i, j) for i, x in enumerate(held) for j, y in enumerate(held[:i]) if 100 * len(x[2] & y[2]) >= 80 * len(x[2] | y[2])], int).reshape(-1, 2).T
        root = passages._roots(a, b, len(held))
        for r in np.unique(root):
            docs = {held[i][0] for i in np.flatnonzero(root == r)}
            if len(docs) > 1:
                want |= {(g, held[i][0], held[i][1]): min(docs) for i in np.flatnonzero(root == r)}
    assert got == want and len(want) > 1000


def test_long_lists_of_near_windows_are_compared_whole():
    """Many windows of the same commonest shingles: some next to a clean one, others linked in pairs only."""
    rng = np.random.default_rng(9)
    n, w, frames = 700, passages.WIDTH, passages.FRAME
    frame = np.tile(np.arange(frames), (n, 1)).astype(np.uint32)
    for i in range(n):
        at = rng.integers(0, 40)
        frame[i, at : at + (5 if i % 2 else 6)] = 1000 + 10 * (i // 4 if i % 4 < 3 else i) + np.arange(5 if i % 2 else 6)
    own = np.zeros((n, w), bool)
    own[:, 10:13] = True
    zeros, number = np.zeros(n, np.int64), np.arange(n)
    for clean in (False, True):
        if clean:
            frame[n // 2] = np.arange(frames)
        x, y, k = passages._near_pairs(zeros, zeros, number, number, number, frame, own)
        for f in range(10, 13):
            sets = np.stack([np.isin(np.arange(20_000), r[f : f + w]) for r in frame]).astype(np.float32)
            inter, size = sets @ sets.T, sets.sum(axis=1)
            a, b = np.nonzero(180 * inter >= 80 * (size[:, None] + size))
            want = passages._roots(a, b, n)
            assert (passages._roots(x[k == f], y[k == f], n) == want).all() and 20 < len(np.unique(want)) < n


def test_work_on_a_group_follows_its_frames():
    """A common line in 20,000 surroundings: only windows that may be near to others are compared."""
    rng = np.random.default_rng(10)
    n, w, frames = 20_000, passages.WIDTH, passages.FRAME
    frame = rng.integers(0, 1 << 32, (n, frames)).astype(np.uint32)
    frame[:, 30:55] = np.arange(25)
    frame[1::1000] = frame[::1000]
    frame[1::1000, 20] = 7
    own = np.zeros((n, w), bool)
    own[:, 18:30] = True
    zeros, number = np.zeros(n, np.int64), np.arange(n)
    began = time.process_time()
    x, y, k = passages._near_pairs(zeros, zeros, number, number, number, frame, own)
    assert time.process_time() - began < 10
    assert set(zip(x // 1000, y // 1000, k, strict=True)) == {(i, i, f) for i in range(20) for f in range(18, 30)}
