"""Check the targets of a migration: no repeated keys, no orphans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shopshift import schemas
from shopshift.operators.constraints import key_violations
from shopshift.sources.tables import live_folders, read_table


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the declared keys of the target model among the given tables."""
    return key_violations(
        tables,
        {t: cols for t, cols in schemas.PRIMARY_KEYS.items() if t in tables},
        [f for f in schemas.FOREIGN_KEYS if f[0] in tables and f[2] in tables],
    )


def check_targets(spark: SparkSession, target_base: str) -> DataFrame:
    """Violations among the target tables as they are now; tables that do not exist are left out."""
    names = {*schemas.PRIMARY_KEYS, *[f[0] for f in schemas.FOREIGN_KEYS]}
    paths = {n: f"{target_base.rstrip('/')}/{n}" for n in sorted(names)}
    return violations({n: read_table(spark, p) for n, p in paths.items() if live_folders(spark, p)})
