"""Grouped aggregates.

Each is a single ``groupBy().agg()``: Spark aggregates partially inside every
map task before the shuffle, so a key holding a large share of the rows still
sends one row per task, never the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.keys import leading_token, tokens


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key (A1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_per_leading_token(df: DataFrame, col: str, name: str = "n", sep: str = ",") -> DataFrame:
    """Rows per leading ``sep``-token of ``col`` (P5 + A1: units per area)."""
    return df.select(leading_token(col, sep).alias(col)).groupBy(col).agg(
        F.count(F.lit(1)).alias(name)
    )


def explode_tokens(df: DataFrame, col: str, keep: Sequence[str] = (), sep: str = ",",
                   name: str = "token") -> DataFrame:
    """One row per ``sep``-token of ``col`` (P5, general 1 -> N form)."""
    return df.select(*keep, F.explode(tokens(col, sep)).alias(name))


def sum_and_count(
    df: DataFrame, keys: Sequence[str], value: str, total: str = "total", count: str = "n_days"
) -> DataFrame:
    """Sum of ``value`` and number of rows per key in one pass (A2)."""
    return df.groupBy(*keys).agg(
        F.sum(value).cast("bigint").alias(total), F.count(F.lit(1)).alias(count)
    )


def mean_from(df: DataFrame, total: str = "total", count: str = "n_days", name: str = "mean",
              as_float: bool = False) -> DataFrame:
    """``total / count`` (A3); ``as_float`` keeps the original 32-bit result."""
    mean = F.col(total).cast("double") / F.col(count)
    return df.withColumn(name, mean.cast("float") if as_float else mean)


def merge_rows(df: DataFrame, keys: Sequence[str], value: str = "total") -> DataFrame:
    """Collapse rows sharing ``keys`` by summing ``value`` (A4: merges supplier rows)."""
    return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def total_per_key(df: DataFrame, keys: Sequence[str], value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` per key as bigint."""
    return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(name))
