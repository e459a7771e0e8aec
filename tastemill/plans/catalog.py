"""All registered queries."""

from tastemill.plans import (  # noqa: F401
    queries_data,
    queries_evaluate,
    queries_integrity,
    queries_models,
    queries_monitor,
    queries_search,
    queries_stream,
)
from tastemill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
