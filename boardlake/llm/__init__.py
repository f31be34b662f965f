"""Operators for large-scale training data. `QUERIES` and `ORACLE_SQL` are what the entry point registers."""

from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
