"""Row filters on a date column.

All are plain range predicates on the typed column, so Catalyst pushes them
through projections and joins down to the scan, and a table stored partitioned
by date prunes files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.dates import date_lit, year_bounds


def in_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """Rows whose date falls in ``year`` (F1: the original tested for the year text)."""
    start, end = year_bounds(year)
    return df.filter((F.col(col) >= date_lit(start)) & (F.col(col) < date_lit(end)))


def on_or_after(df: DataFrame, col: str, start: dt.date) -> DataFrame:
    """Rows dated ``start`` or later (F2)."""
    return df.filter(F.col(col) >= date_lit(start))


def before(df: DataFrame, col: str, cutoff: dt.date) -> DataFrame:
    """Rows dated strictly before ``cutoff``."""
    return df.filter(F.col(col) < date_lit(cutoff))


def in_range(df: DataFrame, col: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """``start <= col < end``; either bound may be omitted."""
    if start is not None:
        df = on_or_after(df, col, start)
    if end is not None:
        df = before(df, col, end)
    return df


def text_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """Rows whose text contains ``needle`` (X2, for inputs still held as strings)."""
    return df.filter(F.col(col).contains(needle))
