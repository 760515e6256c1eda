"""Queries over the given tables, each with the SQL that must give the same rows."""

from tierflow.catalogue import changes, metadata, records, rules, tables, wagering  # noqa: F401
from tierflow.catalogue.shared import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
