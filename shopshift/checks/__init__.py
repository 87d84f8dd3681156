"""Named checks: each pairs a Spark query built from the library with an SQL oracle."""

from shopshift.checks.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "queries", "oracle_sql"]
