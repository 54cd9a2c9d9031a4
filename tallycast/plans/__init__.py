"""User-level pipelines."""

from tallycast.plans.daily_mean import daily_mean_per_unit
from tallycast.plans.next_month import monthly_trends, next_month_forecasts, next_month_top_k
from tallycast.plans.share import forecast_total_share, history_and_forecast, history_union_forecast
from tallycast.plans.sweep import (
    exact_centres,
    exact_segments,
    exact_split_tree,
    share_segments,
    vector_segments,
    vector_sweep,
)

__all__ = [
    "daily_mean_per_unit",
    "exact_centres",
    "exact_segments",
    "exact_split_tree",
    "forecast_total_share",
    "history_and_forecast",
    "history_union_forecast",
    "monthly_trends",
    "next_month_forecasts",
    "next_month_top_k",
    "share_segments",
    "vector_segments",
    "vector_sweep",
]
