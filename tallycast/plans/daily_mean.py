"""Q1: mean daily count per service unit, per area and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.dates import month_start
from tallycast.operators.aggregates import count_per_leading_token, mean_from, sum_and_count
from tallycast.operators.filters import in_year


def daily_mean_per_unit(
    daily: DataFrame,
    units: DataFrame,
    year: int,
    as_float: bool = False,
) -> DataFrame:
    """(area, month, days, total, units, mean_per_unit) for every area with units.

    ``daily`` is (area, obs_date, total), one row per area and day; the mean
    divides by the rows present in the month (days without a row do not count).
    ``units`` is (area, unit), one row per unit. Areas without units drop out
    (inner join). ``as_float`` rounds both divisions to 32-bit float like the
    original output.

    Plan: the year predicate reaches the scan; the (area, month) aggregate and
    the units count are each one partial+final aggregate; the join is between
    two per-area results, small enough for the size-checked broadcast.
    """
    per_month = sum_and_count(
        in_year(daily, "obs_date", year).withColumn("month", month_start("obs_date")),
        ["area", "month"],
        "total",
    )
    means = mean_from(per_month, as_float=as_float)
    counts = count_per_leading_token(units, "area", name="units")
    out = means.join(counts, "area")
    per_unit = F.col("mean") / F.col("units")
    return out.select(
        "area",
        "month",
        "n_days",
        "total",
        "units",
        (per_unit.cast("float") if as_float else per_unit).alias("mean_per_unit"),
    )
