"""Registered queries (Spark) and their SQL twins (DuckDB)."""

from lumisort.catalog.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
