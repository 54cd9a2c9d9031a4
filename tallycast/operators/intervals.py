"""Exact k-means and bisecting k-means in one dimension (M2, M3, M4, M5, M7).

On a line an optimal cluster is an interval of the sorted values, so a model is its cuts. The
cuts come from a dynamic programme over blocks of neighbouring values, of which only counts,
sums and squares reach the driver, MAX_BLOCKS at a time. With at most that many distinct
values every block is one value and the programme is exact at once. Otherwise blocks are
value ranges summed by one Spark aggregate per round, and rounds refine them:

* Replacing a block's values by their mean lowers the cost of a solution by the block's own squares
  if it has no cut inside, and by at most ``slack`` = range * sqrt(n * squares) more if it has:
  with parts j of size n_j and mean m_j, block mean m, cluster centres c_j and any constant c, the
  difference is the squares plus 2 * sum(n_j * (m_j - m) * (c - c_j)). Cutting inside a block of equal values is
  never better than at one of its ends (the cost is concave in how many of them go left).
* So a cut inside block b costs at least the best solution through one end of b, less the
  slack of the blocks it may cut. Blocks where that exceeds the best solution found are
  closed, closed neighbours without a useful boundary are merged, and the rest are split.

Rounds end, for each k, when no block can hold a cut; the slack shrinks with the square of the width, so each
round divides the open range by the number of parts. Should twice MAX_BLOCKS blocks not
do, which takes that many near-equal solutions, the best cuts found are returned; their
cost is within the slack of the best.

Clusters are numbered by centre. Equal values share a cluster, and there are never more
clusters than distinct values. Null and NaN values belong to no cluster. Equal costs go to the smaller cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1024
ROUNDING = 1e-13  # relative to the sum of squares: differences below are rounding


@dataclass
class Blocks:
    """Ascending blocks of values: bounds, counts, and sums about ``origin``."""

    lo: np.ndarray
    hi: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    origin: float

    def __post_init__(self):
        self.sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (self.n, self.s, self.q)]

    def __len__(self) -> int:
        return len(self.n)

    def cost(self, i, j):
        """Squares of blocks i .. j - 1 about their mean."""
        n, s, q = (x[j] - x[i] for x in self.sums)
        return np.maximum(q - s * s / np.maximum(n, 1.0), 0.0)

    def part(self, i: int, j: int) -> Interval:
        n, s = (x[j] - x[i] for x in self.sums[:2])
        return Interval(float(self.lo[i]), float(self.hi[j - 1]), int(n), self.origin + float(s / n), float(self.cost(i, j)))


@dataclass(frozen=True)
class Interval:
    """A cluster: its least and greatest value, size, centre and cost."""

    lo: float
    hi: float
    size: int
    centre: float
    cost: float


@dataclass
class Node:
    """A cluster of the bisecting tree; ``parent`` and ``node`` are numbers, the root is 1."""

    node: int
    parent: int | None
    interval: Interval
    children: list[Node] = field(default_factory=list)


@dataclass(frozen=True)
class Segmentation:
    """A fitted model: the clusters in ascending order."""

    algorithm: str
    k: int
    clusters: tuple[Interval, ...]

    @property
    def cost(self) -> float:
        return sum(c.cost for c in self.clusters)

    def cluster_of(self, value: Column) -> Column:
        """Number of the value's cluster, null for null and NaN."""
        above = [F.when(value > F.lit(c.hi), 1).otherwise(0) for c in self.clusters[:-1]]
        number = sum(above, F.lit(0)) if self.clusters else F.lit(None)
        return F.when(value.isNotNull() & ~F.isnan(value), number).cast("int")


class Values:
    """The values of a frame, as block sums at any value edges."""

    def __init__(self, df: DataFrame, col: str):
        v = F.col(col).cast("double")
        self.df = df.select(v.alias("v")).filter(v.isNotNull() & ~F.isnan(v))
        self.rows: list | None = None

    def between(self, lo: float, hi: float) -> Values:
        return Values(self.df.filter((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi))), "v")

    def single(self, most: int) -> Blocks | None:
        """A block per distinct value, or None if there are more than ``most``."""
        if self.rows is None:
            self.rows = sorted(self.df.groupBy("v").count().limit(most + 1).collect())
        rows = self.rows
        if len(rows) > most:
            return None
        v = np.array([r["v"] for r in rows], dtype=np.float64)
        n = np.array([r["count"] for r in rows], dtype=np.float64)
        origin = float((v * n).sum() / n.sum()) if len(v) else 0.0
        return Blocks(v, v, n, n * (v - origin), n * (v - origin) ** 2, origin)

    def range(self) -> tuple[float, float, float]:
        """Least, greatest and mean value."""
        return tuple(self.df.agg(F.min("v"), F.max("v"), F.avg("v")).first())

    def summed(self, edges: Sequence[float], origin: float) -> Blocks:
        """Blocks between the edges; an edge is the greatest value that goes left of it. Empty blocks go."""
        above = [float(np.nextafter(e, np.inf)) for e in edges]  # the buckets start at their edge
        cut = Bucketizer(splits=[-np.inf, *above, np.inf], inputCol="v", outputCol="b")
        d = F.col("v") - F.lit(origin)
        rows = cut.transform(self.df).groupBy("b").agg(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"),
            F.sum(d).alias("s"), F.sum(d * d).alias("q"),
        ).collect()
        rows.sort(key=lambda r: r["b"])
        return Blocks(*(np.array([r[c] for r in rows], dtype=np.float64) for c in ("lo", "hi", "n", "s", "q")), origin)


def _costs(b: Blocks) -> np.ndarray:
    """Cost from boundary i to boundary j (i < j; infinite else)."""
    i, j = np.meshgrid(np.arange(len(b) + 1), np.arange(len(b) + 1), indexing="ij")
    return np.where(i < j, b.cost(np.minimum(i, j), j), np.inf)


def _forward(costs: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Least cost of the blocks up to each boundary in 1 .. k clusters, and where the last begins."""
    best, came = [costs[0]], [np.zeros(len(costs), np.int64)]
    for _ in range(1, k):
        total = best[-1][:, None] + costs
        came.append(total.argmin(axis=0))
        best.append(total.min(axis=0))
    return best, came


def _backward(costs: np.ndarray, k: int) -> list[np.ndarray]:
    """Least cost of the blocks from each boundary on in 1 .. k clusters."""
    best = [costs[:, -1]]
    for _ in range(1, k):
        best.append((costs + best[-1][None, :]).min(axis=1))
    return best


def _bounds(came: list[np.ndarray], k: int, end: int) -> list[int]:
    out = [end]
    for j in range(k - 1, 0, -1):
        out.append(int(came[j][out[-1]]))
    return [0, *reversed(out)]


def solve(b: Blocks, k: int) -> tuple[Interval, ...]:
    """The best cuts at block bounds."""
    k = min(k, len(b))
    if not k:
        return ()
    _, came = _forward(_costs(b), k)
    at = _bounds(came, k, len(b))
    return tuple(b.part(i, j) for i, j in zip(at[:-1], at[1:], strict=True))


def _slack(b: Blocks) -> np.ndarray:
    at = np.arange(len(b))
    return (b.hi[-1] - b.lo[0]) * np.sqrt(b.n * b.cost(at, at + 1))


def _open(b: Blocks, k: int, may_split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that may hold a cut of a best solution, and boundaries that may be one."""
    if k < 2 or k > len(b):
        return may_split & (k > 1), np.ones(len(b) + 1, bool)
    slack = np.where(may_split, _slack(b), 0.0)
    costs = _costs(b)
    ahead, behind = _forward(costs, k)[0], _backward(costs, k)
    through = np.min([ahead[j] + behind[k - 2 - j] for j in range(k - 1)], axis=0)
    limit = ahead[k - 1][-1] + ROUNDING * float(b.cost(0, len(b)))
    largest = np.sort(slack)[::-1]
    others = largest[: k - 2].sum()
    # moving a cut to an end of its block may empty a cluster
    near = np.minimum(np.minimum(through[:-1], through[1:]), ahead[k - 2][-1])
    inside = may_split & (near - slack - others <= limit)
    bound = through - others - largest[0] <= limit
    bound[[0, -1]] = True
    return inside, bound


def _refined(
    b: Blocks, inside: np.ndarray, bound: np.ndarray, room: int
) -> tuple[list[float], list[tuple[float, float]]]:
    """New edges, and the ranges that stay closed: the open blocks with most slack are split evenly, closed neighbours merged."""
    some = np.flatnonzero(inside)
    some = some[np.argsort(-_slack(b)[some], kind="stable")][: max(1, room // 4)]
    parts = max(2, min(16, 1 + room // 2 // len(some)))  # half the room is left for the rounds to come
    split = set(some.tolist())
    edges: list[float] = []
    closed: list[tuple[float, float]] = []
    for i in range(len(b)):
        lo, hi = float(b.lo[i]), float(b.hi[i])
        if i in split:
            steps = lo + (hi - lo) * (np.arange(1, parts) / parts)
            edges += [float(x) for x in np.unique(np.minimum(steps, np.nextafter(hi, -np.inf))) if x >= lo]
        elif not inside[i]:
            if closed and not bound[i] and closed[-1][1] == b.hi[i - 1]:
                edges.pop()
                closed[-1] = (closed[-1][0], hi)
            else:
                closed.append((lo, hi))
        edges.append(hi)
    return edges[:-1], closed


def optimal(values: Values, ks: Sequence[int], max_blocks: int = MAX_BLOCKS) -> dict[int, tuple[Interval, ...]]:
    """For each k the clusters of the least sum of squares."""
    b = values.single(max_blocks)
    if b is not None:
        return {k: solve(b, k) for k in ks}
    lo, hi, mean = values.range()
    steps = lo + (hi - lo) * (np.arange(1, max_blocks // 2) / (max_blocks // 2))
    first = [float(x) for x in np.unique(steps)]
    return {k: _rounds(values, k, first, mean, max_blocks) for k in ks}


def _rounds(values: Values, k: int, edges: list[float], origin: float, max_blocks: int) -> tuple[Interval, ...]:
    closed: list[tuple[float, float]] = []
    while True:
        b = values.summed(edges, origin)
        shut = {lo for lo, _ in closed}
        may_split = (b.hi > b.lo) & np.array([lo not in shut for lo in b.lo.tolist()])
        inside, bound = _open(b, k, may_split)
        room = 2 * max_blocks - len(b)
        if not inside.any() or room < 2:
            return solve(b, k)
        edges, closed = _refined(b, inside, bound, room)


def bisect(values: Values, k: int, max_blocks: int = MAX_BLOCKS) -> tuple[Node | None, dict[int, list[Node]]]:
    """The tree of exact two-way splits, and its leaves for 1 .. k clusters.

    Level by level every leaf is split; where fewer splits are left than leaves, the
    largest go first (equal sizes: the smaller centre), so the leaves for each number of clusters are those of
    a bisection that stops there.
    """
    single = values.single(max_blocks)

    def halves(interval: Interval) -> tuple[Interval, ...]:
        if single is not None:
            i, j = np.searchsorted(single.lo, interval.lo), np.searchsorted(single.lo, interval.hi, side="right")
            part = Blocks(*(x[i:j] for x in (single.lo, single.hi, single.n, single.s, single.q)), single.origin)
            return solve(part, 2)
        return optimal(values.between(interval.lo, interval.hi), [2], max_blocks)[2]

    whole = solve(single, 1) if single is not None else optimal(values, [1], max_blocks)[1]
    if not whole:
        return None, {}
    root = Node(1, None, whole[0])
    made = 1
    leaves, by_k = [root], {1: [root]}
    while len(leaves) < k:
        order = sorted((x for x in leaves if x.interval.lo < x.interval.hi), key=lambda x: (-x.interval.size, x.interval.centre))
        if not order:
            break
        for x in order:
            for half in halves(x.interval):
                made += 1
                x.children.append(Node(made, x.node, half))
            at = leaves.index(x)
            leaves = leaves[:at] + x.children + leaves[at + 1 :]
            by_k[len(leaves)] = leaves
            if len(leaves) == k:
                break
    for n in range(len(leaves) + 1, k + 1):
        by_k[n] = leaves
    return root, by_k


def fit(df: DataFrame, col: str, algorithms: Sequence[str], ks: Sequence[int], max_blocks: int = MAX_BLOCKS) -> list[Segmentation]:
    """A model per (algorithm, k), algorithms ``kmeans`` and ``bisecting``."""
    values = Values(df, col)
    out = []
    for algorithm in algorithms:
        if algorithm == "kmeans":
            found = optimal(values, ks, max_blocks)
            out += [Segmentation(algorithm, k, found[k]) for k in ks]
        elif algorithm == "bisecting":
            _, leaves = bisect(values, max(ks, default=1), max_blocks)
            out += [Segmentation(algorithm, k, tuple(x.interval for x in leaves.get(k, []))) for k in ks]
        else:
            raise ValueError(f"no exact form of {algorithm!r}")
    return out


def tree_rows(root: Node | None) -> list[tuple[int, int | None, float, float, int, float, float, bool]]:
    """(node, parent, lo, hi, size, centre, cost, leaf) of the tree, top down."""
    rows, todo = [], [root] if root else []
    while todo:
        x = todo.pop(0)
        i = x.interval
        rows.append((x.node, x.parent, i.lo, i.hi, i.size, i.centre, i.cost, not x.children))
        todo += x.children
    return rows
