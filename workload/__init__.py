"""Queries over the given tables, each with equivalent SQL where SQL can say it."""

from workload import markup, places, postings, records, stores, texts  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
