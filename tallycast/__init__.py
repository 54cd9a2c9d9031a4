"""tallycast: trend, ranking and segmentation analytics for daily count data on PySpark.

Layout:
  sources/    typed readers (CSV with declared schemas, parquet tables, table analogues)
  sinks/      CSV / keyed-table writers and read-back
  functions/  column expressions (dates, rounding, keys, tokens)
  operators/  DataFrame -> DataFrame building blocks (filters, aggregates, trend, rank, cluster)
  plans/      the user-level pipelines built from the operators
  streaming/  incremental ingest of new CSV drops into the typed daily table
"""

from tallycast.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
