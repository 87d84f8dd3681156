"""Literal lookup frames built from a run's configuration (bounded, broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopshift.config import MigrationConfig
from shopshift.sources.tables import inline_lookup


def status_map(spark: SparkSession, cfg: MigrationConfig) -> DataFrame:
    return inline_lookup(spark, "legacy_status_id int, status string", cfg.order_status_map)


def payment_map(spark: SparkSession, cfg: MigrationConfig) -> DataFrame:
    return inline_lookup(spark, "legacy_method string, target_method string", cfg.payment_method_map)


def card_type_map(spark: SparkSession, cfg: MigrationConfig) -> DataFrame:
    return inline_lookup(spark, "legacy_cc_type string, target_cc_type string", cfg.card_type_map)


def product_type_map(spark: SparkSession, cfg: MigrationConfig) -> DataFrame:
    return inline_lookup(spark, "legacy_type string, target_set_name string, target_category string", cfg.product_type_map)
