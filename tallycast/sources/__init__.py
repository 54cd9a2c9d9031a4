"""Readers: declared-schema CSV (S1-S6) and the warehouse-derived pipeline inputs."""

from tallycast.sources import schemas
from tallycast.sources.csv import bind_columns, ddl_fields, read_bound, read_csv, read_csv_with_rejects, split_rejects
from tallycast.sources.tables import (
    TABLES,
    daily_totals_table,
    embedding_features,
    population_table,
    supplier_rows,
    table,
    units_table,
)

__all__ = [
    "TABLES",
    "bind_columns",
    "daily_totals_table",
    "ddl_fields",
    "embedding_features",
    "population_table",
    "read_bound",
    "read_csv",
    "read_csv_with_rejects",
    "schemas",
    "split_rejects",
    "supplier_rows",
    "table",
    "units_table",
]
