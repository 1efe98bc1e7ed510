"""Queries over the test tables, each with SQL that must give the same rows."""

from . import analytics, changes, predicates, relations, remote, scalars  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
