"""Metadata-driven medallion pipelines expressed as plain Spark jobs."""

__version__ = "0.1.0"
