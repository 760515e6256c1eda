"""The dealt queries over the given tables, each beside its SQL where SQL can say it."""

from __future__ import annotations

from tierflow.llm import pattern_queries, queries  # noqa: F401
from tierflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
