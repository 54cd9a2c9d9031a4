"""Total to a cutoff date, plus the forecast for the cutoff day, as a share of population."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.dates import date_lit, day_offset
from tallycast.functions.numeric import ratio
from tallycast.operators.filters import before
from tallycast.operators.trend import forecast, linear_trend


def history_and_forecast(
    daily: DataFrame,
    cutoff: dt.date,
    origin: dt.date | None = None,
) -> DataFrame:
    """(area, history, n, forecast): totals before ``cutoff`` and the line's value at it.

    One aggregate pass per area gives both the history sum and the fit. The
    forecast is truncated toward zero; 0 when the area has one day only.
    ``origin`` sets x = days since origin (default: the cutoff itself).
    """
    origin = origin or cutoff
    hist = before(daily, "obs_date", cutoff).withColumn("x", day_offset("obs_date", origin))
    fits = linear_trend(
        hist, ["area"], "x", "total", extra=[F.sum("total").cast("bigint").alias("history")]
    )
    x0 = F.lit((cutoff - origin).days)
    return fits.select(
        "area", "history", "n", forecast(x0, rounding="toward_zero").alias("forecast")
    )


def history_union_forecast(daily: DataFrame, cutoff: dt.date, origin: dt.date | None = None) -> DataFrame:
    """(area, obs_date, total, kind): the history rows and one forecast row per area."""
    hist = before(daily, "obs_date", cutoff).select(
        "area", "obs_date", F.col("total").cast("bigint").alias("total"), F.lit("history").alias("kind")
    )
    fc = history_and_forecast(daily, cutoff, origin).select(
        "area", date_lit(cutoff).alias("obs_date"), F.col("forecast").alias("total"),
        F.lit("forecast").alias("kind"),
    )
    return hist.unionByName(fc)


def forecast_total_share(
    daily: DataFrame,
    population: DataFrame,
    cutoff: dt.date,
    origin: dt.date | None = None,
) -> DataFrame:
    """(area, history, forecast, total, population, ratio); areas without population drop out."""
    hf = history_and_forecast(daily, cutoff, origin)
    total = (F.col("history") + F.col("forecast")).cast("bigint")
    return hf.join(population, "area").select(
        "area",
        "history",
        "forecast",
        total.alias("total"),
        "population",
        ratio(total, F.col("population")).alias("ratio"),
    )
