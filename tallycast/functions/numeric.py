"""Numeric expressions: rounding rules of the forecasts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places a forecast is rounded to before the integer rounding rule is
# applied, so last-bit noise of the fit at exact halves does not flip the result.
GUARD_DIGITS = 6


def round_half_up(c: Column, guard: int = GUARD_DIGITS) -> Column:
    """Nearest integer, halves toward +infinity (``-2.5 -> -2``, ``2.5 -> 3``).

    ``round`` would send ``-2.5`` to ``-3``; this is ``floor(x + 0.5)``.
    """
    return F.floor(F.round(c, guard) + F.lit(0.5)).cast("bigint")


def truncate_to_long(c: Column, guard: int = GUARD_DIGITS) -> Column:
    """Integer part, toward zero (``-0.5 -> 0``, ``16.9 -> 16``)."""
    return F.round(c, guard).cast("bigint")


def ratio(num: Column, den: Column, as_float: bool = False) -> Column:
    """``num / den`` in double, optionally narrowed to 32-bit float."""
    out = num.cast("double") / den.cast("double")
    return out.cast("float") if as_float else out
