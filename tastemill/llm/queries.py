"""All queries of the corpus operators."""

from tastemill.llm import queries_dedup, queries_model, queries_records, queries_text  # noqa: F401
from tastemill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
