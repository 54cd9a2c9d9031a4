"""Incremental ingest of feed drops (S1 as a file stream).

New CSV files landing in a folder are parsed with the feed's declared schema
and appended to a parquet table partitioned by month; ``read_ingested`` turns
a date range into a predicate on the partition column, so only the months in
range are listed and read. Several drops may repeat a key (area, day,
band, supplier); the pipelines sum rows per key (``merge_rows``), so appended
deltas add up correctly without rewriting the table.

Progress is tracked in ``{table_dir}/_progress``: a restarted or failed run, in
any application, resumes from the last committed file set.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycast.functions.dates import date_lit, month_start
from tallycast.sources.csv import DATE_FORMAT, ddl_fields, raw_options, raw_schema, split_rejects


def feed_stream(
    spark: SparkSession,
    source_dir: str,
    ddl: str,
    header: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame over the CSV files arriving in ``source_dir``."""
    reader = (
        spark.readStream.schema(ddl)
        .option("header", header)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "FAILFAST")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def ingest(
    spark: SparkSession,
    source_dir: str,
    ddl: str,
    table_dir: str,
    date_col: str = "obs_date",
    header: bool = False,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start appending the feed to ``table_dir`` partitioned by ``month``.

    ``available_now`` processes everything present and stops (scheduled
    batch-style runs); otherwise the query keeps running on new files.
    """
    if checkpoint is None:
        # beside the data (readers skip names with an underscore), so every later run finds it
        checkpoint = f"{table_dir.rstrip('/')}/_progress"
    stream = feed_stream(spark, source_dir, ddl, header).withColumn("month", month_start(F.col(date_col)))
    writer = (
        stream.writeStream.format("parquet")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("month")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_with_rejects(
    spark: SparkSession,
    source_dir: str,
    ddl: str,
    table_dir: str,
    date_col: str = "obs_date",
    header: bool = False,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """``ingest`` for feeds with bad lines: good rows reach the table, the others ``{table_dir}/_rejects``.

    The rules are those of ``read_csv_with_rejects``. Both outputs are partitioned by the micro-batch, and a
    batch that runs again after a failure overwrites its own partitions, so every line is
    written once. ``checkpoint`` must go with the table: batch numbers start anew with a new one.
    """
    table_dir = table_dir.rstrip("/")
    raw = spark.readStream.schema(raw_schema(ddl)).options(**raw_options(header)).csv(source_dir)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            good, rejects = split_rejects(held, ddl)
            good = good.withColumns({"month": month_start(F.col(date_col)), "batch": F.lit(number)})
            for rows, path, parts in (
                (good, table_dir, ["month", "batch"]), (rejects.withColumn("batch", F.lit(number)), f"{table_dir}/_rejects", ["batch"]),
            ):
                writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(*parts).parquet(path)
        finally:
            held.unpersist()

    writer = (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{table_dir}/_progress")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_rejects(spark: SparkSession, table_dir: str) -> DataFrame:
    """The rejected raw rows of an ingested table, with the micro-batch that met them."""
    return spark.read.parquet(f"{table_dir.rstrip('/')}/_rejects")


def read_ingested(
    spark: SparkSession,
    table_dir: str,
    ddl: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    date_col: str = "obs_date",
) -> DataFrame:
    """The ingested table with its declared columns (partition column dropped).

    ``start``/``end`` (end exclusive) filter ``date_col`` and, derived from
    them, the ``month`` partition column -- the latter prunes partitions.
    """
    df = spark.read.parquet(table_dir)
    if start is not None:
        df = df.filter((F.col("month") >= month_start(date_lit(start))) & (F.col(date_col) >= date_lit(start)))
    if end is not None:
        df = df.filter((F.col("month") <= month_start(date_lit(end))) & (F.col(date_col) < date_lit(end)))
    return df.select(*[name for name, _ in ddl_fields(ddl)])
