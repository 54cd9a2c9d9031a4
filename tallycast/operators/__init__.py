"""DataFrame -> DataFrame building blocks of the pipelines."""

from tallycast.operators import aggregates, cluster, filters, rank, trend

__all__ = ["aggregates", "cluster", "filters", "rank", "trend"]
