"""Least-squares trend lines per group, and forecasts from them.

The line is fitted with Spark's declarative regression aggregates
(``regr_count``/``regr_slope``/``regr_intercept``). Their buffers are moments
that merge across partitions, so the fit is partially aggregated in every map
task and a group of any size never has to sit in one task.

x is a day offset from a caller-chosen origin rather than epoch milliseconds:
a least-squares line is invariant to shifting x, and small offsets keep the
moments well conditioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.numeric import round_half_up, truncate_to_long


def linear_trend(
    df: DataFrame,
    keys: Sequence[str],
    x: str | Column,
    y: str | Column,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """keys + (n, slope, intercept) of the line ``y = intercept + slope * x`` per group.

    ``slope``/``intercept`` are null when the group has fewer than two distinct x
    values. ``extra`` adds more aggregates to the same pass.
    """
    xc = F.col(x) if isinstance(x, str) else x
    yc = (F.col(y) if isinstance(y, str) else y).cast("double")
    xd = xc.cast("double")
    return df.groupBy(*keys).agg(
        F.regr_count(yc, xd).alias("n"),
        F.regr_slope(yc, xd).alias("slope"),
        F.regr_intercept(yc, xd).alias("intercept"),
        *extra,
    )


def is_degenerate(slope: str | Column = "slope") -> Column:
    """True when no line is defined (fewer than two distinct x values)."""
    s = F.col(slope) if isinstance(slope, str) else slope
    return s.isNull() | F.isnan(s)


def forecast(
    x0: Column,
    rounding: str = "half_up",
    slope: str = "slope",
    intercept: str = "intercept",
) -> Column:
    """Integer forecast at ``x0`` (bigint); 0 when no line is defined.

    ``rounding``: ``"half_up"`` (nearest, halves up, X12) or ``"toward_zero"`` (X13).
    """
    value = F.col(intercept) + F.col(slope) * x0.cast("double")
    if rounding == "half_up":
        rounded = round_half_up(value)
    elif rounding == "toward_zero":
        rounded = truncate_to_long(value)
    else:
        raise ValueError(f"unknown rounding {rounding!r}")
    return F.when(is_degenerate(slope), F.lit(0).cast("bigint")).otherwise(rounded)
