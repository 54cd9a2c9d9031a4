"""Exact one-dimensional clusters against brute force over all cuts."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import KMEANS_OPTIMUM, PUBLISHED_SHARES, SF001
from tallycast import registry
from tallycast.operators import cluster, intervals
from tallycast.plans import exact_centres, exact_segments, exact_split_tree, vector_sweep
from tallycast.sources import embedding_features


def squares(part):
    m = math.fsum(part) / len(part)
    return math.fsum((x - m) ** 2 for x in part)


def brute(values, k):
    """Least cost over all cuts between distinct values."""
    v = sorted(values)
    steps = [i for i in range(1, len(v)) if v[i] > v[i - 1]]
    k = min(k, len(steps) + 1)
    return min(
        math.fsum(squares(v[a:b]) for a, b in zip([0, *cuts], [*cuts, len(v)])) for cuts in itertools.combinations(steps, k - 1)
    )


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "ratio double")


def sample(rnd, n):
    kind = rnd.choice(["even", "lumps", "ties", "tail"])
    if kind == "even":
        return [rnd.random() for _ in range(n)]
    if kind == "lumps":
        return [rnd.gauss(rnd.choice([0, 1, 5]), 0.3) for _ in range(n)]
    if kind == "ties":
        return [float(rnd.randrange(7)) for _ in range(n)]
    return [rnd.expovariate(1) ** 3 for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_optimum_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    values = sample(rnd, rnd.choice([2, 5, 12, 25]))
    for m in intervals.fit(frame(spark, values), "ratio", ["kmeans"], [2, 3, 4]):
        assert m.cost == pytest.approx(brute(values, m.k), rel=1e-9, abs=1e-12)
        assert [c.centre for c in m.clusters] == sorted(c.centre for c in m.clusters)


@pytest.mark.parametrize("seed", range(5))
def test_rounds_of_blocks_find_the_same_clusters(spark, seed):
    rnd = random.Random(100 + seed)
    values = sample(rnd, 400)
    whole = intervals.optimal(intervals.Values(frame(spark, values), "ratio"), [2, 3, 5])
    parts = intervals.optimal(intervals.Values(frame(spark, values), "ratio"), [2, 3, 5], max_blocks=100)
    for k in whole:
        assert [(c.lo, c.hi, c.size) for c in parts[k]] == [(c.lo, c.hi, c.size) for c in whole[k]]
        assert sum(c.cost for c in parts[k]) == pytest.approx(sum(c.cost for c in whole[k]), rel=1e-9, abs=1e-12)


class Counted(intervals.Values):
    """Values already sorted in memory, to try the rounds on many rows without Spark."""

    def __init__(self, values):
        self.v, self.rounds = np.sort(np.array(values)), 0

    def range(self):
        return self.v[0], self.v[-1], self.v.mean()

    def single(self, most):
        return None

    def summed(self, edges, origin):
        self.rounds += 1
        at = np.unique(np.concatenate([[0], np.searchsorted(self.v, edges, side="right"), [len(self.v)]]))
        d = self.v - origin
        cut = at[:-1]
        return intervals.Blocks(
            self.v[cut], self.v[at[1:] - 1], np.diff(at).astype(float), np.add.reduceat(d, cut), np.add.reduceat(d * d, cut), origin
        )


@pytest.mark.parametrize("seed", range(6))
def test_rounds_on_many_values(seed):
    rnd = np.random.default_rng(seed)
    v = rnd.gamma(2.0, size=3000) if seed % 2 else np.concatenate([rnd.normal(c, 0.7, 1000) for c in (0, 2, 9)])
    held = Counted(v)
    found = intervals.optimal(held, [2, 4], max_blocks=128)
    s = np.sort(v)
    one = intervals.Blocks(s, s, np.ones(len(s)), s - s.mean(), (s - s.mean()) ** 2, s.mean())
    for k in (2, 4):
        best = intervals.solve(one, k)
        assert sum(c.cost for c in found[k]) == pytest.approx(sum(c.cost for c in best), rel=1e-12)
        assert [c.size for c in found[k]] == [c.size for c in best]
    assert held.rounds < 40


def test_published_shares_reach_the_optimum_in_any_layout(spark):
    shares = spark.createDataFrame(PUBLISHED_SHARES, "area string, ratio double")
    got = []
    for n in (1, 5):
        out = exact_segments(shares.repartition(n))
        got.append(sorted(map(tuple, out.select("algorithm", "k", "area", "cluster", "cost").collect())))
        for r in out.select("algorithm", "k", "cost", "wssse").distinct().collect():
            assert r.wssse == pytest.approx(r.cost, rel=1e-9)
            if r.algorithm == "kmeans":
                assert r.cost == pytest.approx(KMEANS_OPTIMUM[r.k], rel=1e-9)
            else:
                assert r.cost >= KMEANS_OPTIMUM[r.k] * (1 - 1e-12)
    assert got[0] == got[1]


def test_split_tree_is_consistent(spark):
    shares = spark.createDataFrame(PUBLISHED_SHARES, "area string, ratio double")
    tree = {r.node: r for r in exact_split_tree(shares, 5).collect()}
    assert len(tree) == 9 and sum(r.leaf for r in tree.values()) == 5
    for r in tree.values():
        halves = [c for c in tree.values() if c.parent == r.node]
        assert len(halves) == (0 if r.leaf else 2)
        if halves:
            assert sum(c.size for c in halves) == r.size and sum(c.cost for c in halves) <= r.cost
            values = [v for _, v in PUBLISHED_SHARES if r.lo <= v <= r.hi]
            assert sum(c.cost for c in halves) == pytest.approx(brute(values, 2), rel=1e-9)
    bisected = sum(r.cost for r in tree.values() if r.leaf)
    centres = exact_centres(shares, ks=[5], algorithms=["bisecting"]).collect()
    assert sum(r.cost for r in centres) == pytest.approx(bisected, rel=1e-12)


def test_nulls_nan_ties_and_few_values(spark):
    rows = [("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None), ("e", float("nan"))]
    out = exact_segments(spark.createDataFrame(rows, "area string, ratio double"), ks=[2, 4]).collect()
    assert {(r.algorithm, r.k, r.area): r.cluster for r in out if r.area in "abc"} == {
        (a, k, x): int(x == "c") for a in ("kmeans", "bisecting") for k in (2, 4) for x in "abc"
    }
    assert all(r.cluster is None for r in out if r.area in "de")
    assert {r.cost for r in out} == {0.0} and {r.wssse for r in out} == {0.0}
    empty = exact_segments(spark.createDataFrame([], "area string, ratio double"))
    assert empty.count() == 0
    assert exact_split_tree(spark.createDataFrame([], "area string, ratio double")).count() == 0


def test_nearest_centre_tells_a_shuffled_assignment(spark):
    points = embedding_features(spark, SF001)
    sweep = vector_sweep(points, "vec_id", "embedding", ks=[3], algorithms=["kmeans"])
    assigned = sweep.assigned("vec_id").join(points, "vec_id")
    found = cluster.nearest_centre(assigned, sweep.centres(), "embedding")
    own, misplaced = found.agg(F.sum("own"), F.count_if(F.col("own") > F.col("least") * (1 + 1e-9))).first()
    assert misplaced == 0
    assert own == pytest.approx(sweep.wssse["kmeans", 3], rel=1e-9)
    turned = assigned.withColumn("cluster", (F.col("cluster") + 1) % 3)
    own, misplaced = cluster.nearest_centre(turned, sweep.centres(), "embedding").agg(
        F.sum("own"), F.count_if(F.col("own") > F.col("least") * (1 + 1e-9))
    ).first()
    assert misplaced > 0 and own > 1.1 * sweep.wssse["kmeans", 3]


def test_sweep_from_a_stored_layout_has_no_shuffle_and_the_same_costs(spark, tmp_path):
    points = embedding_features(spark, SF001).select("vec_id", "embedding")
    stored = cluster.store_layout(points, ["vec_id"], str(tmp_path / "layout"))
    a = vector_sweep(points.repartition(5), "vec_id", "embedding", ks=[2, 3])
    b = vector_sweep(stored, "vec_id", "embedding", ks=[2, 3], canonical=False)
    for sweep in (a, b):
        assert "Exchange" not in sweep.rows()._jdf.queryExecution().executedPlan().toString()
    costs = [{(x, k): m.summary.trainingCost for x, k, m in s.fitted} for s in (a, b)]
    assert costs[0] == costs[1] and len(costs[0]) == 4


def test_speed_per_algorithm_and_k(spark):
    rows = registry.cluster_speed(spark, SF001).collect()
    assert [(r.algorithm, r.k) for r in rows] == [(a, k) for a in ("kmeans", "bisecting") for k in (2, 3, 4, 5)]
    assert all(r.seconds > 0 and r.iterations >= 1 and r.cost > 0 for r in rows)
    sweep = spark.createDataFrame(
        [(r.algorithm, r.k, 0, r.cost, r.cost) for r in rows], "algorithm string, k int, cluster int, cost double, wssse double"
    )
    compared = cluster.compare(sweep, spark.createDataFrame(rows)).collect()
    assert all(r.seconds > 0 and r.iterations >= 1 for r in compared) and len(compared) == 8
