"""Segment areas by their share with k-means and bisecting k-means over a range of k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.operators import intervals
from tallycast.operators.cluster import (
    ALGORITHMS,
    DEFAULT_KS,
    DEFAULT_MAX_ITER,
    DEFAULT_RESTARTS,
    Sweep,
    cluster_sweep,
    fit_sweep,
    vectorize,
    vectorize_array,
)
from tallycast.session import checkpoint_dir


def share_segments(
    shares: DataFrame,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
    key: str = "area",
    value: str = "ratio",
    restarts: int = DEFAULT_RESTARTS,
    canonical: bool = True,
) -> DataFrame:
    """(algorithm, k, area, ratio, cluster, cost, wssse) from a per-area share table.

    The shares come out of the whole forecast pipeline, so the features are
    checkpointed before training (a lost executor re-reads them).
    """
    features = vectorize(shares.select(key, value), [value])
    return cluster_sweep(
        features, [key, value], ks, algorithms, max_iter, seed, cut_lineage=True, restarts=restarts, canonical=canonical
    )


def exact_segments(
    shares: DataFrame,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    key: str = "area",
    value: str = "ratio",
) -> DataFrame:
    """The rows of ``share_segments`` under the best clusters there are, numbered by centre.

    Shares are one-dimensional, so the k-means optimum and each two-way split of the bisection
    are found exactly (``operators.intervals``): no seed, no restarts, the same result in any
    layout. ``cost`` comes from the fit, ``wssse`` is added up again over the rows. The shares are
    checkpointed, as several aggregates read them.
    """
    rows = _checkpointed(shares.select(key, value))
    models = intervals.fit(rows, value, algorithms, ks)
    v = F.col(value).cast("double")
    known = v.isNotNull() & ~F.isnan(v)
    sums = []
    for m in models:
        centre = F.element_at(F.array(*[F.lit(c.centre) for c in m.clusters]), m.cluster_of(v) + 1) if m.clusters else v
        sums.append(F.coalesce(F.sum(F.when(known, (v - centre) * (v - centre))), F.lit(0.0)))
    wssse = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first() if models else []
    per_model = F.array(*[
        F.struct(
            F.lit(m.algorithm).alias("algorithm"), F.lit(m.k).cast("int").alias("k"), m.cluster_of(v).alias("cluster"),
            F.lit(m.cost).alias("cost"), F.lit(float(wssse[i])).alias("wssse"),
        )
        for i, m in enumerate(models)
    ])
    return rows.select(key, value, F.inline(per_model)).select("algorithm", "k", key, value, "cluster", "cost", "wssse")


def exact_centres(
    shares: DataFrame,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    value: str = "ratio",
) -> DataFrame:
    """(algorithm, k, cluster, lo, hi, size, centre, cost): the clusters of ``exact_segments``, one row each."""
    rows = [
        (m.algorithm, m.k, i, c.lo, c.hi, c.size, c.centre, c.cost)
        for m in intervals.fit(_checkpointed(shares.select(value)), value, algorithms, ks)
        for i, c in enumerate(m.clusters)
    ]
    return shares.sparkSession.createDataFrame(
        rows, "algorithm string, k int, cluster int, lo double, hi double, size long, centre double, cost double"
    )


def exact_split_tree(shares: DataFrame, k: int = max(DEFAULT_KS), value: str = "ratio") -> DataFrame:
    """(node, parent, lo, hi, size, centre, cost, leaf): the bisection's splits on the way to k clusters.

    Node 1 is the whole; the s-th split makes the nodes 2s (lower half) and 2s + 1.
    """
    root, _ = intervals.bisect(intervals.Values(_checkpointed(shares.select(value)), value), k)
    return shares.sparkSession.createDataFrame(
        intervals.tree_rows(root),
        "node int, parent int, lo double, hi double, size long, centre double, cost double, leaf boolean",
    )


def _checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def vector_sweep(
    vectors: DataFrame,
    id_col: str,
    array_col: str,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
    restarts: int = 1,
    canonical: bool = True,
) -> Sweep:
    """The fitted grid over vectors given as ``array<double>``: its rows, centres and split trees."""
    features = vectorize_array(vectors.select(id_col, array_col), array_col)
    return fit_sweep(
        features, [id_col], ks, algorithms, max_iter, seed, cut_lineage=False, restarts=restarts, canonical=canonical
    )


def vector_segments(
    vectors: DataFrame,
    id_col: str,
    array_col: str,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
) -> DataFrame:
    """The same sweep over any-width vectors given as ``array<double>``, one start per k (see ``vector_sweep``)."""
    return vector_sweep(vectors, id_col, array_col, ks, algorithms, max_iter, seed).rows()
