"""Clustering sweep and its quality measures.

Models are ``pyspark.ml`` estimators: every training iteration is a distributed
aggregate over the feature rows, and only the k centres live on the driver.

* ``fit_sweep`` fits every (algorithm, k) of a grid on one feature frame, stored
  once in a canonical layout (lineage cut, so a lost executor re-reads features
  instead of recomputing the upstream pipeline) and cached while the models
  train; ``cluster_sweep`` gives its rows. ``intervals`` has the exact form for one dimension.
* ``nearest_centre`` recomputes distances from the centre table, ``split_tree`` shows how
  bisecting split, ``timed_fits`` how long each model trains.
* ``assignment_cost`` is WSSSE as a plain aggregate: rows joined to their
  centre, squared distance summed per model. The centre table has one row per
  (model, cluster), bounded by the grid, so it is broadcast; the sweep runs it
  once for all models while the features are cached.
* ``label_cost`` is the cost of an existing assignment (clusters = labels, centre =
  mean of the members), computed in one pass from per-label variances: no join,
  no shuffle of raw rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.util import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.session import checkpoint_dir, scratch_path

ALGORITHMS = ("kmeans", "bisecting")
DEFAULT_KS = (2, 3, 4, 5)
DEFAULT_MAX_ITER = 20
DEFAULT_KMEANS_SEED = 42


def _java_string_hash(s: str) -> int:
    """``String.hashCode`` of the JVM (deterministic, unlike Python's ``hash``)."""
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


# The JVM library's own default seed for bisecting k-means (hash of its class
# name). PySpark's default is Python's per-process randomised string hash, so
# it is pinned here to keep runs reproducible.
DEFAULT_BISECTING_SEED = _java_string_hash("org.apache.spark.mllib.clustering.BisectingKMeans")
DEFAULT_PARALLELISM = 4
DEFAULT_RESTARTS = 4
DEFAULT_BISECTING_ITER = 20  # the library's default; the original gave bisecting no iterations
LAYOUT_ROWS = 65_536         # feature rows per partition while training


def vectorize(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Scalar columns -> one dense vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def vectorize_array(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """``array<double>`` column -> dense vector column."""
    return df.withColumn(out, array_to_vector(F.col(col)))


def estimator(
    algorithm: str,
    k: int,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
    features_col: str = "features",
    prediction_col: str = "cluster",
):
    """The estimator for ``algorithm`` (M2, M3, M8).

    ``kmeans`` uses k-means|| initialisation and a fixed default seed so runs
    repeat. ``bisecting`` keeps the library's defaults, as the original did,
    with the seed pinned to the JVM library default; ``max_iter`` is for k-means only.
    """
    if algorithm == "kmeans":
        est = KMeans(
            k=k,
            maxIter=max_iter,
            seed=DEFAULT_KMEANS_SEED if seed is None else seed,
            featuresCol=features_col,
            predictionCol=prediction_col,
        )
    elif algorithm == "bisecting":
        est = BisectingKMeans(
            k=k,
            maxIter=DEFAULT_BISECTING_ITER,
            seed=DEFAULT_BISECTING_SEED if seed is None else seed,
            featuresCol=features_col,
            predictionCol=prediction_col,
        )
    else:
        raise ValueError(f"algorithm must be one of {ALGORITHMS}, got {algorithm!r}")
    return est


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two ``array<double>`` columns, JVM-side."""
    diffs = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


CENTRE_SCHEMA = "array<struct<algorithm:string,k:int,cluster:int,centre:array<double>>>"


def centre_table(spark, fitted: Iterable[tuple[str, int, object]]) -> DataFrame:
    """(algorithm, k, cluster, centre array<double>) for fitted models (k rows each).

    The few centre rows travel as one JSON literal parsed in the JVM: no
    Python worker processes, a handful of driver calls, and doubles round-trip
    exactly (Python writes the shortest exact representation).
    """
    payload = json.dumps([
        {"algorithm": algo, "k": int(k), "cluster": i, "centre": [float(v) for v in centre]}
        for algo, k, model in fitted
        for i, centre in enumerate(model.clusterCenters())
    ])
    return spark.range(1).select(F.inline(F.from_json(F.lit(payload), CENTRE_SCHEMA)))


def assignment_cost(
    assigned: DataFrame,
    centres: DataFrame,
    model_keys: Sequence[str] = ("algorithm", "k"),
    features_col: str = "features",
    cluster_col: str = "cluster",
    name: str = "wssse",
) -> DataFrame:
    """Per model: sum of squared distances of rows to their assigned centre (M6)."""
    keys = [*model_keys, cluster_col]
    pts = assigned.select(*keys, vector_to_array(F.col(features_col)).alias("_x"))
    return (
        pts.join(F.broadcast(centres), keys)
        .groupBy(*model_keys)
        .agg(F.sum(squared_distance(F.col("_x"), F.col("centre"))).alias(name))
    )


def model_cost(
    model,
    df: DataFrame,
    features_col: str = "features",
    name: str = "wssse",
) -> DataFrame:
    """One-row frame: WSSSE of ``df`` under a fitted model (M1, M6; ``computeCost``).

    ``model.transform`` assigns each row, then ``assignment_cost`` sums the
    squared distances to the model's centres (k rows, broadcast).
    """
    spark = df.sparkSession
    pred = model.getPredictionCol()
    assigned = model.transform(df).select(
        F.lit("model").alias("algorithm"), F.lit(0).alias("k"), features_col,
        F.col(pred).cast("int").alias("cluster"),
    )
    centres = centre_table(spark, [("model", 0, model)])
    return assignment_cost(assigned, centres, features_col=features_col, name=name).select(name)


@dataclass
class Sweep:
    """A fitted grid: the feature rows it was trained on, and a model per (algorithm, k)."""

    data: DataFrame
    keep: list[str]
    features_col: str
    fitted: list[tuple[str, int, object]]
    wssse: dict[tuple[str, int], float]

    def predicted(self) -> DataFrame:
        """The feature rows with one prediction column ``_cluster<i>`` per model, in one pass."""
        wide = self.data
        for i, (_, _, model) in enumerate(self.fitted):
            wide = model.copy({model.predictionCol: f"_cluster{i}"}).transform(wide)
        return wide

    def _per_model(self, *more) -> Column:
        return F.array(*[
            F.struct(
                F.lit(a).alias("algorithm"), F.lit(k).cast("int").alias("k"),
                F.col(f"_cluster{i}").cast("int").alias("cluster"), *[f(a, k, model) for f in more],
            )
            for i, (a, k, model) in enumerate(self.fitted)
        ])

    def assigned(self, *keep: str) -> DataFrame:
        """(keep..., algorithm, k, cluster): every row once per model."""
        return self.predicted().select(*keep, F.inline(self._per_model()))

    def rows(self) -> DataFrame:
        """(algorithm, k, keep..., cluster, cost, wssse): one scan of the rows, lazy."""
        models = self._per_model(
            lambda a, k, model: F.lit(float(model.summary.trainingCost)).alias("cost"),
            lambda a, k, model: F.lit(self.wssse[a, k]).alias("wssse"),
        )
        wide = self.predicted().select(*self.keep, F.inline(models))
        return wide.select("algorithm", "k", *self.keep, "cluster", "cost", "wssse")

    def centres(self) -> DataFrame:
        """(algorithm, k, cluster, centre array<double>)."""
        return centre_table(self.data.sparkSession, self.fitted)

    def split_trees(self) -> DataFrame:
        """(k, node, parent, size, cost, centre, leaf) of the bisecting models."""
        spark, out = self.data.sparkSession, None
        for a, k, model in self.fitted:
            if a == "bisecting":
                tree = split_tree(spark, model).select(F.lit(k).cast("int").alias("k"), "*")
                out = tree if out is None else out.unionByName(tree)
        return spark.createDataFrame([], TREE_SCHEMA) if out is None else out


def laid_out(df: DataFrame, keys: Sequence[str], rows_per_file: int = LAYOUT_ROWS) -> DataFrame:
    """Rows dealt and sorted by ``keys``, in files of about ``rows_per_file``.

    Training adds up in row order, so one layout gives one result whatever partitioning the
    rows came in. Write it once (``store_layout``) and any later sweep trains without a shuffle.
    """
    files = max(1, -(-df.count() // rows_per_file))
    return df.repartition(files, *keys).sortWithinPartitions(*keys)


def store_layout(df: DataFrame, keys: Sequence[str], path: str, rows_per_file: int = LAYOUT_ROWS) -> DataFrame:
    """``laid_out`` written as parquet and read back."""
    laid_out(df, keys, rows_per_file).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_sweep(features: DataFrame, keep: Sequence[str], *args, **kwargs) -> DataFrame:
    """The rows of ``fit_sweep``: one per (algorithm, k, input row) (M7).

    Columns: algorithm, k, ``keep``..., cluster, cost (training cost), wssse (cost of the whole
    input under the model). Training runs now; the rows are lazy, one scan for all models.
    """
    return fit_sweep(features, keep, *args, **kwargs).rows()


def fit_sweep(
    features: DataFrame,
    keep: Sequence[str],
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
    features_col: str = "features",
    parallelism: int = DEFAULT_PARALLELISM,
    cut_lineage: bool = True,
    restarts: int = DEFAULT_RESTARTS,
    canonical: bool = True,
) -> Sweep:
    """Fit every (algorithm, k), up to ``parallelism`` models at a time.

    Each fit is its own series of Spark jobs, as in ``CrossValidator``; the WSSSE of all models is one
    aggregate over the cached features.

    ``canonical`` stores the rows once in the layout of ``laid_out`` under the shared scratch folder;
    training and the returned rows read that table, without a shuffle. ``False`` trains in the given
    layout, for rows that are stored laid out already.

    ``cut_lineage`` checkpoints the features first -- worth it when they come out of joins and
    aggregations; for a plain projection of a stored table (``False``) recomputing a lost
    partition is just a re-read.

    ``restarts`` > 1 fits k-means from that many seeds (``seed``, ``seed + 1``, ...) and keeps the
    model with the lowest training cost per k; k-means only finds a local optimum from any one start.
    """
    spark = features.sparkSession
    data = features.select(*keep, features_col)
    if cut_lineage:
        checkpoint_dir(spark)
        data = data.checkpoint(eager=True)
    if canonical:
        data = store_layout(data, keep, scratch_path(spark, "sweep"))
    data.persist(StorageLevel.MEMORY_AND_DISK)
    data.count()  # materialise once, before the concurrent fits read it
    base_seed = DEFAULT_KMEANS_SEED if seed is None else seed
    grid = [
        (algo, k, base_seed + r if algo == "kmeans" else seed)
        for algo in algorithms
        for k in ks
        for r in range(restarts if algo == "kmeans" else 1)
    ]

    def fit(item):
        algo, k, s = item
        return algo, k, estimator(algo, k, max_iter, s, features_col, "cluster").fit(data)

    # longest fits first (bisecting runs max_iter iterations per split, more
    # splits for larger k), so the pool does not end on one long straggler
    grid.sort(key=lambda g: (g[0] != "bisecting", -g[1]))
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(grid)))) as pool:
            candidates = list(pool.map(inheritable_thread_target(spark)(fit), grid))
        best: dict[tuple[str, int], object] = {}
        for algo, k, model in candidates:  # grid order: ties keep the first seed
            key = (algo, k)
            if key not in best or model.summary.trainingCost < best[key].summary.trainingCost:
                best[key] = model
        sweep = Sweep(data, list(keep), features_col, [(algo, k, model) for (algo, k), model in best.items()], {})
        sweep.wssse = _sweep_wssse(sweep.assigned(features_col), sweep.fitted, features_col)
    finally:
        data.unpersist()
    return sweep


def timed_fits(
    features: DataFrame,
    ks: Sequence[int] = DEFAULT_KS,
    algorithms: Sequence[str] = ALGORITHMS,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int | None = None,
    features_col: str = "features",
) -> DataFrame:
    """(algorithm, k, seconds, iterations, cost): speed of each algorithm, fitted one after the other (M9).

    The features are cached first and one untimed fit warms up, so a time is that of its training alone.
    """
    data = features.select(features_col).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        data.count()
        for algo in algorithms:
            estimator(algo, min(ks), 1, seed, features_col).fit(data)
            for k in ks:
                began = time.perf_counter()
                model = estimator(algo, k, max_iter, seed, features_col).fit(data)
                took = time.perf_counter() - began
                rows.append((algo, k, took, model.summary.numIter, model.summary.trainingCost))
    finally:
        data.unpersist()
    return features.sparkSession.createDataFrame(
        rows, "algorithm string, k int, seconds double, iterations int, cost double"
    )


TREE_SCHEMA = "k int, node int, parent int, size long, cost double, centre array<double>, leaf boolean"


def split_tree(spark: SparkSession, model) -> DataFrame:
    """(node, parent, size, cost, centre, leaf) of a fitted bisecting model, read from its saved form (M3)."""
    path = scratch_path(spark, "bisecting-model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data/data")  # at most 2k - 1 rows
    parents = nodes.select(F.col("index").alias("parent"), F.explode("children").alias("child"))
    tree = nodes.join(parents, F.col("index") == F.col("child"), "left")
    return tree.select(
        F.col("index").cast("int").alias("node"), F.col("parent").cast("int").alias("parent"), F.col("size").cast("long").alias("size"),
        "cost", vector_to_array("center").alias("centre"), (F.size("children") == 0).alias("leaf"),
    )


def nearest_centre(
    assigned: DataFrame,
    centres: DataFrame,
    vector_col: str,
    model_keys: Sequence[str] = ("algorithm", "k"),
    cluster_col: str = "cluster",
) -> DataFrame:
    """``assigned`` with ``own`` and ``least``: squared distances to the row's own and to its nearest centre (M6).

    ``centres`` (see ``centre_table``) has one row per (model, cluster), bounded by the grid; ``vector_col``
    is ``array<double>``. The sum of ``own`` is the model's cost, and ``own > least`` a misplaced row.
    """
    per_model = centres.groupBy(*model_keys).agg(F.collect_list(F.struct(F.col("cluster").alias("c"), "centre")).alias("_centres"))
    rows = assigned.join(F.broadcast(per_model), list(model_keys))
    distances = F.transform("_centres", lambda x: F.struct(squared_distance(F.col(vector_col), x["centre"]).alias("d"), x["c"].alias("c")))
    rows = rows.withColumn("_distances", distances)
    own = F.filter("_distances", lambda x: x["c"] == F.col(cluster_col))[0]["d"]
    return rows.select(*assigned.columns, own.alias("own"), F.array_min("_distances")["d"].alias("least"))


def _sweep_wssse(assigned: DataFrame, fitted, features_col: str) -> dict[tuple[str, int], float]:
    """WSSSE per model from one grouped pass: squares around each cluster's mean, plus its shift from the centre.

    One row per (algorithm, k, cluster) comes back.
    """
    stats = assigned.groupBy("algorithm", "k", "cluster").agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col(features_col)).alias("s")
    )
    centres = {(a, k): model.clusterCenters() for a, k, model in fitted}
    out = dict.fromkeys(centres, 0.0)
    for r in stats.collect():
        mean, variance, n = r["s"]["mean"].toArray(), r["s"]["variance"].toArray(), r["s"]["count"]
        shift = mean - centres[r["algorithm"], r["k"]][r["cluster"]]
        out[r["algorithm"], r["k"]] += float((n - 1) * variance.sum() + n * (shift * shift).sum())
    return out


def compare(sweep: DataFrame, speed: DataFrame | None = None) -> DataFrame:
    """Per (algorithm, k): cost, wssse, clusters used, size; ranked by wssse within k (M9).

    ``speed`` (see ``timed_fits``) adds seconds and iterations. One row per model: the ranking
    window runs over the (tiny) model table.
    """
    clusters = sweep.groupBy("algorithm", "k", "cluster").agg(
        F.first("cost").alias("cost"), F.first("wssse").alias("wssse"), F.count(F.lit(1)).alias("n")
    )
    per_model = clusters.groupBy("algorithm", "k").agg(
        F.first("cost").alias("cost"),
        F.first("wssse").alias("wssse"),
        F.count(F.lit(1)).alias("clusters_used"),
        F.sum("n").alias("rows"),
    )
    w = Window.partitionBy("k").orderBy(F.col("wssse").asc(), F.col("algorithm").asc())
    ranked = per_model.withColumn("rank_in_k", F.row_number().over(w))
    if speed is None:
        return ranked
    return ranked.join(speed.select("algorithm", "k", "seconds", "iterations"), ["algorithm", "k"], "left")


def label_cost(df: DataFrame, vector_col: str, label_col: str, name: str = "wssse") -> DataFrame:
    """Per label: members and within-label sum of squared distances to the label mean (M6).

    ``vector_col`` is ``array<double>``. Uses ``(n - 1) * sum(sample variance)``,
    a mergeable one-pass aggregate: a label holding most rows is still combined
    map-side.
    """
    stats = (
        df.select(label_col, array_to_vector(F.col(vector_col)).alias("_v"))
        .groupBy(label_col)
        .agg(Summarizer.metrics("count", "variance").summary(F.col("_v")).alias("_s"))
    )
    var = vector_to_array(F.col("_s.variance"))
    n = F.col("_s.count")
    return stats.select(
        label_col,
        n.cast("bigint").alias("n"),
        ((n - F.lit(1)).cast("double") * F.aggregate(var, F.lit(0.0), lambda a, v: a + v)).alias(name),
    )
