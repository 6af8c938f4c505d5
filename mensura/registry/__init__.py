"""Every query by name: (session, folder of the shared tables) -> DataFrame."""

from mensura.registry import check_queries, forecast_queries, layer_queries, load_queries, metric_queries
from mensura.registry.base import Query, queries

__all__ = [
    "Query",
    "check_queries",
    "forecast_queries",
    "layer_queries",
    "load_queries",
    "metric_queries",
    "queries",
]
