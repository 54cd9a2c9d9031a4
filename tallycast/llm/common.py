"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.session import release_scratch, scratch_path

# A word: a run of characters other than ASCII white space. In Python the same words come
# from ``bytes.split()`` on the UTF-8 text.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once (an expression used in a lambda is else evaluated per element)."""
    return F.transform(F.array(value), body)[0]


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more; it finds them by garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialise`` with the path it wrote, for a caller that releases it."""
    spark = df.sparkSession
    release_shuffles(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    return stored(df, name)[0]


class Scratch:
    """Tables written on the way to a result, deleted together once the result itself is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        out, path = stored(df, name)
        self.paths.setdefault(name, []).append(path)
        return out

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Store under a name and delete what was stored under it before."""
        before = self.paths.pop(name, [])
        out = self.store(df, name)
        release_scratch(self.spark, before)
        return out

    def drop(self, name: str) -> None:
        """Delete what was stored under a name."""
        release_scratch(self.spark, self.paths.pop(name, []))

    def release(self) -> None:
        for paths in self.paths.values():
            release_scratch(self.spark, paths)
        self.paths = {}


def worker_state(owner: str) -> dict:
    """The owner's dict, which lives in the Python worker across its tasks, until another owner's task asks for one there."""
    import pyspark

    held = pyspark.__dict__.setdefault("_tallycast_worker_state", {})
    if others := held.keys() - {owner}:
        for other in others:
            del held[other]
        gc.collect()
        give_back()
    return held.setdefault(owner, {})


def give_back() -> None:
    """Return freed memory to the system; a Python worker waits for its next task with it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of mapInPandas; at the end of a task the worker gives back what it has freed."""

    def ran(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return ran


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, name: str = "components", scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for the nodes of (a, b) edges; root is the smallest node of the component.

    Each step's edges replace those of the step before; with ``scratch`` the last are released with it.

    Alternating large-star and small-star steps until no edge changes: each step is one
    grouped aggregate and one join over the edges, which never grow in number. A hub with
    most edges is combined map-side and its join partition can be split.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    e = scratch.replace(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), name
    )
    last = None
    while True:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: every node hands its smaller neighbours, and itself, to the smallest of them
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smallest, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        e = scratch.replace(small.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), name)
        now = e.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == last:
            break
        last = now
    return e.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root").union(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
