"""Q2: per band and month, the k areas with the largest forecast for the next month's first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.dates import day_offset, month_start, next_month_start
from tallycast.operators.aggregates import merge_rows
from tallycast.operators.filters import in_range
from tallycast.operators.rank import top_k
from tallycast.operators.trend import forecast, linear_trend


def monthly_trends(
    banded: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    keys: tuple[str, ...] = ("area", "band"),
    measure: str = "total",
) -> DataFrame:
    """(month, area, band, n, slope, intercept): the daily line of each month.

    ``banded`` is (area, obs_date, band, total) with possibly several rows per
    day (one per supplier); they are summed to one value per day first, so the
    fit sees daily totals. x is the day offset from the month's first day.

    Supplier rows are merged first (partial aggregation in every map task, so a
    hot key ships one row per task), and the fit is partially aggregated before
    its shuffle on (month, area, band). ``measure`` is the column summed.
    """
    daily = merge_rows(in_range(banded, "obs_date", start, end), ["obs_date", *keys], measure)
    rows = daily.withColumn("month", month_start("obs_date"))
    with_x = rows.withColumn("x", day_offset("obs_date", "month"))
    return linear_trend(with_x, ["month", *keys], "x", measure)


def next_month_forecasts(trends: DataFrame) -> DataFrame:
    """Adds (next_month, forecast): the line at the next month's first day, halves up."""
    nxt = next_month_start("month")
    return trends.withColumn("next_month", nxt).withColumn(
        "forecast", forecast(day_offset(nxt, "month"), rounding="half_up")
    )


def next_month_top_k(
    banded: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    k: int = 5,
    measure: str = "total",
) -> DataFrame:
    """(next_month, band, area, forecast, rank) with rank <= k per (next_month, band).

    Ties on the forecast are broken by area, ascending. Groups with fewer than
    two days forecast 0; negative forecasts are kept.
    """
    fc = next_month_forecasts(monthly_trends(banded, start, end, measure=measure))
    # at most k rows per group and task reach the ranking's shuffle
    ranked = top_k(
        fc,
        ["month", "band"],
        [F.col("forecast").desc(), F.col("area").asc()],
        k,
    )
    return ranked.select("next_month", "band", "area", "forecast", "rank")
