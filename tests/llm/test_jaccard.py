"""The Jaccard join against all pairs on the words, with small regions so that every round runs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallycast.llm import hashing, jaccard
from tallycast.llm.common import Scratch

CLASHES = ["_tie", "_k", "_nth", "_all", "_bad", "_pass", "_n", "_d", "_s", "_t", "k", "tie", "row", "nth", "whole", "node", "part"]


def shingle_sets(texts, size):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute(texts, ids, size, percent):
    sets = shingle_sets(texts, size)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    return sorted((ids[i], len(sets[i]), least[find(i)]) for i in range(len(texts)))


def families(seed, n=70):
    """Families of near copies at all distances, all with one common passage, so that cells are hot."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(25)]
    texts = []
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 40, 80]))] for _ in range(12)]
    while len(texts) < n:
        w = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
            i = rnd.randrange(len(w))
            w[i : i + rnd.randrange(2)] = [rnd.choice(words)]
        if rnd.random() < 0.5:
            w = w + passage
        texts.append(" ".join(w))
    return texts + ["", None, " \n", "One", "one", texts[0].upper(), texts[1]]


def result(found):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())


@pytest.mark.parametrize(("seed", "region", "closest"), [(1, 512, 4), (2, 3, 1), (3, 8, 1)])
def test_components_against_all_pairs(spark, documents, monkeypatch, seed, region, closest):
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "CLOSEST", closest)
    texts = families(seed)
    for size, percent in ((4, 85), (5, 80)) if seed == 1 else ((2, 60),):
        got = result(jaccard.components(documents(texts), size, percent))
        assert got == brute(texts, range(len(texts)), size, percent)


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_words_that_collide_under_a_polynomial_stay_apart(spark, documents):
    x, y = thue_morse(2048, 0), thue_morse(2048, 1)
    assert hashing.word_hashes(x.encode())[0] != hashing.word_hashes(y.encode())[0]
    docs = documents([f"one two three {x}", f"one two three {y}", x, y])
    assert [c for *_, c in result(jaccard.components(docs))] == [0, 1, 2, 3]
    assert jaccard.keep_first(docs, jaccard.components(docs)).count() == 4


def test_any_column_names_and_repeated_ids(spark, documents):
    texts = [f"a b c d e {i // 2}" for i in range(40)] + ["", "", None]
    ids = [1] * 20 + list(range(20, 40)) + [7, 7, 7]
    docs = documents(texts, ids).drop("node", "tie")
    for i, c in enumerate(CLASHES):
        docs = docs.withColumn(c, F.lit(i))
    docs = docs.withColumn("a.b", F.lit("dot"))
    found = jaccard.components(docs)
    assert found.count() == len(texts)
    kept = jaccard.keep_first(docs, found)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all([r[c] for c in CLASHES] == list(range(len(CLASHES))) for r in rows)
    assert len(rows) == 20 + 3
    assert sorted(r.text for r in rows if r.text) == sorted({t for t in texts if t})


def test_many_rows_under_one_id_fetch_one_text_per_set(spark, documents):
    texts = [f"w{i} x{i} y{i} z{i}" for i in range(60)]
    docs = documents(texts, [5] * 60)
    known = jaccard.nodes(docs).filter("part IS NULL").drop("part", "counts").cache()
    assert jaccard.sets_of(docs, known, known.select("node"), Scratch(spark)).count() == 60
    assert result(jaccard.components(docs)) == [(5, 1, 5)] * 60


def test_bitmaps_never_exceed_the_difference():
    import numpy as np

    rnd = np.random.default_rng(1)
    for _ in range(50):
        both = rnd.integers(0, 2**63, rnd.integers(0, 300)).astype(np.uint64)
        x = np.unique(np.concatenate([both, rnd.integers(0, 2**63, rnd.integers(0, 200)).astype(np.uint64)]))
        y = np.unique(np.concatenate([both, rnd.integers(0, 2**63, rnd.integers(0, 200)).astype(np.uint64)]))
        bits = jaccard._bitmaps([jaccard.parity(x), jaccard.parity(y)])
        assert jaccard.hamming(bits[0], bits[1]) <= len(np.setxor1d(x, y))


def test_bitmap_lets_all_wanted_texts_through(spark):
    texts = spark.range(3_000).selectExpr("if(id % 100 = 7, null, id) AS doc_id", "concat('t', id % 2000) AS text")
    texts = jaccard._texts(texts)
    one = texts.filter("doc_id IS NULL OR doc_id % 20 = 0").selectExpr("doc_id AS d", "tie AS z", "1L AS node")
    passed = jaccard._probed(texts, one)
    assert passed.filter("doc_id IS NULL OR doc_id % 20 = 0").count() == one.count()
    assert passed.count() <= one.count() + 30
    assert jaccard._probed(texts, one.limit(0)).count() == 0


def near_copies(n=300, words=200):
    """Copies of one text with a few words of their own: each two differ, most of them link."""
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for i in range(n):
        w = list(base)
        for j in range(rnd.randrange(3)):
            w[rnd.randrange(words)] = f"own{i}x{j}"
        texts.append(" ".join([*w, f"last{i}"]))
    return texts


def test_pairs_of_a_region_follow_its_members_not_their_square():
    import numpy as np
    import pandas as pd

    sets = [jaccard.shingle_set(t, 4) for t in near_copies()]
    rows = pd.DataFrame(
        {
            "region": 5, "node": [jaccard.node_of(s) for s in sets], "n": [len(s) for s in sets], "pos": 0,
            "r": np.arange(len(sets)), "bits": [jaccard.parity(s) for s in sets],
        }
    )
    found = jaccard._region_pairs(rows, 4, 85)
    pairs = found[~found["more"]]
    assert found["more"].any()
    assert len(rows) - 1 <= len(pairs) <= 4 * (len(rows) - 1)
    # they connect all members, and without a bound none is left out
    root = {x: x for x in rows["node"]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs[["a", "b"]].itertuples(index=False):
        root[find(a)] = find(b)
    assert len({find(x) for x in rows["node"]}) == 1
    assert not jaccard._region_pairs(rows, 4096, 85)["more"].any()


def test_forests_take_the_closest_pairs_and_leave_none_out():
    import numpy as np

    rnd = np.random.default_rng(3)
    x, y = np.triu_indices(30, 1)
    found = np.stack([x * 0 + 9, x, y, rnd.integers(0, 9, len(x)), np.arange(len(x))])
    one = jaccard._forests(found, 1)
    assert one.shape[1] == 29
    # Kruskal
    root, least = list(range(30)), 0
    for i in np.lexsort((found[4], found[3])):
        a, b = root[x[i]], root[y[i]]
        if a != b:
            root = [b if r == a else r for r in root]
            least += found[3, i]
    assert one[3].sum() == least
    assert jaccard._forests(found, 30).shape[1] == len(x)
    assert jaccard._forests(found[:, :0], 3).shape == (5, 0)
