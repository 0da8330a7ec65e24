"""Registered queries over the test tables, each with the SQL that gives the same result."""

from . import bureau, expressions, keyed, monthly, payments  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
