"""Registered queries over the benchmark tables, each with its SQL twin."""

from .registry import ENTRIES, oracle_sql, queries

__all__ = ["ENTRIES", "oracle_sql", "queries"]
