"""Date expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d: dt.date | str) -> Column:
    """A date constant (X11)."""
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d).cast("date")


def month_start(c: ColumnOrName) -> Column:
    """First day of the date's month."""
    return F.trunc(_c(c), "month")


def next_month_start(c: ColumnOrName) -> Column:
    """First day of the following month; December rolls into January of the next year."""
    return F.add_months(F.trunc(_c(c), "month"), 1)


def month_token(c: ColumnOrName) -> Column:
    """Zero-padded month number as text, ``'01'``..``'12'``."""
    return F.date_format(_c(c), "MM")


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """``c.split(sep)[index]`` with a literal separator, 0-based."""
    return F.split(_c(c).cast("string"), _regex_literal(sep)).getItem(index)


def day_offset(c: ColumnOrName, origin: ColumnOrName | dt.date) -> Column:
    """Whole days from ``origin`` (a date, or a date column) to ``c`` (X8): the fit's x axis."""
    o = date_lit(origin) if isinstance(origin, dt.date) else _c(origin)
    return F.datediff(_c(c), o)


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    """``[Jan 1, Jan 1 of next year)`` -- a year filter as a prunable range (F1)."""
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def _regex_literal(sep: str) -> str:
    return re.escape(sep)
