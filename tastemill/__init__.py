"""Recommendation analytics as Spark DataFrame, SQL, ML and Structured Streaming jobs."""

__version__ = "0.1.0"
