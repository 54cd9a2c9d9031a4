"""Top-k per group, nested rankings and global ordering.

``top_k`` is ``row_number() <= k`` over a window partitioned by the group; Spark
plans it with a group limit before and after the shuffle, so at most k rows per
group and task move. A group too large for one task is still fine: the window
sort spills, and the pre-shuffle limit keeps only k candidates per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import checkpoint_dir


def top_k(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of every group under ``order_by`` (ties need a tie-break key)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def nest_ranked(
    df: DataFrame,
    group_by: Sequence[str],
    fields: Sequence[str],
    rank_col: str = "rank",
    name: str = "ranking",
) -> DataFrame:
    """One row per group with its ranked rows as ``array<struct>`` in rank order.

    Only for already-limited input (the output of ``top_k``): each group's list
    is built in one task.
    """
    collected = F.collect_list(F.struct(F.col(rank_col).alias("_r"), *fields))
    ordered = F.array_sort(collected)  # structs sort by their first field: the rank
    return df.groupBy(*group_by).agg(
        F.transform(ordered, lambda s: s.dropFields("_r")).alias(name)
    )


def with_position(df: DataFrame, order_by: Sequence[Column], name: str = "position") -> DataFrame:
    """Attach the 1-based position of every row in a total order (O1, O3).

    Distributed: a range-partitioned sort, then per-partition row counts turned
    into offsets. The offsets table has one row per partition, so it is tiny
    whatever the data size. The sorted rows are checkpointed to the shared
    checkpoint folder so both passes see the same partitioning.
    ``order_by`` must be a total order (break ties) for positions to be unique.
    """
    checkpoint_dir(df.sparkSession)
    tagged = (
        df.orderBy(*order_by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", "_base", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_offset") + (F.col("_mid") - F.col("_base")) + F.lit(1))
        .drop("_pid", "_mid", "_base", "_offset")
    )
