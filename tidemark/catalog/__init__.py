"""Every registered query, by name, with SQL that gives the same result."""

from tidemark.catalog import changes, nested, runs, sources
from tidemark.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
