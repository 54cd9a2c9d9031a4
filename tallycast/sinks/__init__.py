"""Writers and read-back (K1-K5).

Results stay multi-part: every task writes its own file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.keys import KEY_SEPARATOR, row_key
from tallycast.sinks.publish import drop_old_versions, new_version, publish, published
from tallycast.sources.csv import DATE_FORMAT, read_csv


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """CSV directory, one part file per task (K1 headerless, K2 with header)."""
    (
        df.write.mode(mode)
        .option("header", header)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )


def read_csv_dir(spark: SparkSession, path: str, ddl: str, header: bool = False) -> DataFrame:
    """Read back a CSV directory with its declared schema (K5)."""
    return read_csv(spark, path, ddl, header=header)


def duplicate_keys(df: DataFrame, key: str = "row_key") -> DataFrame:
    """Keys that occur more than once (distributed check, partial aggregate)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keyed(df: DataFrame, parts: list[str], values: list[str], key: str = "row_key",
          sep: str = KEY_SEPARATOR) -> DataFrame:
    """(row_key, values...) with the key built from ``parts``."""
    return df.select(row_key(*parts, sep=sep).alias(key), *values)


def write_keyed(df: DataFrame, path: str, key: str = "row_key", check_unique: bool = True) -> None:
    """Keyed result table as parquet (K4). A keyed store keeps one row per key, so
    duplicate keys are an error rather than a silent overwrite."""
    if check_unique and duplicate_keys(df, key).limit(1).count() > 0:
        raise ValueError(f"duplicate {key} values")
    df.write.mode("overwrite").parquet(path)


def write_bucketed(
    df: DataFrame,
    name: str,
    key: str,
    buckets: int,
    path: str | None = None,
) -> None:
    """Catalog table stored hash-bucketed and sorted by ``key``.

    Two tables bucketed by their join key into the same number of buckets join
    without shuffling either side (and without re-sorting), so a fact table
    that is joined on every run -- orders to customer by customer key -- pays
    the shuffle once, at write time. ``path`` places the files (shared storage
    on a cluster); otherwise the session's warehouse folder is used.

    Trade-off: a bucketed join has no shuffle for AQE to split, so a key that
    holds a large share of the rows stays in one bucket (one task). For such
    keys keep the unbucketed layout, where AQE's skew join splits the partition.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """Full read-back of a keyed result table (K5)."""
    return spark.read.parquet(path)


__all__ = [
    "drop_old_versions",
    "duplicate_keys",
    "keyed",
    "new_version",
    "publish",
    "published",
    "read_csv_dir",
    "read_keyed",
    "write_csv",
    "write_bucketed",
    "write_keyed",
]
