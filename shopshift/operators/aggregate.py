"""Aggregates of the migration: per-key counts and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, key: str | Sequence[str], name: str = "product_count") -> DataFrame:
    """A1: ``count(*)`` per key (partial counts per task, then one shuffle of partials)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """A2: ``select distinct`` over columns and constants."""
    return df.select(*cols).distinct()
