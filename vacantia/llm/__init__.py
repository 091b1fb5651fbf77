"""Operators for preparing training data. Nothing else in the package imports this one."""

from vacantia.llm import queries as _queries  # noqa: F401  registers them
from vacantia.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
