"""Reset job: empty target tables before a fresh load, keeping their schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from shopshift.sinks.writers import reset_tables

CUSTOMER_TABLES = ("customer_entity", "customer_entity_varchar")


def reset_job(spark: SparkSession, base: str, names: Sequence[str] = CUSTOMER_TABLES) -> list[str]:
    """Write an empty snapshot of each named table."""
    return reset_tables(spark, base, names)
