"""Reconciliation job: which legacy product became which catalogue product, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import predicates as P
from shopshift.operators.eav import eav_view
from shopshift.operators.joins import reconcile_by_name, reconcile_grouped
from shopshift.plans.products import legacy_products
from shopshift.sinks.writers import record_table

# Declared schema of the record table.
MIGRATION_RECORD = T.StructType(
    [
        T.StructField("legacy_id", T.LongType()),
        T.StructField("legacy_sku", T.StringType()),
        T.StructField("legacy_name", T.StringType()),
        T.StructField("target_id", T.LongType()),
        T.StructField("target_sku", T.StringType()),
        T.StructField("target_name", T.StringType()),
    ]
)


def catalogue_names(tgt: dict[str, DataFrame], legacy_set_id: int) -> DataFrame:
    """Names of catalogue products outside the legacy attribute set."""
    names = tgt["catalog_product_entity_varchar"].select("entity_id", "attribute_id", F.col("value").alias("name"))
    ents = tgt["catalog_product_entity"].select("entity_id", "sku", "attribute_set_id")
    viewed = eav_view(names, ents, C.LEGACY_PRODUCT_ATTR["name"]).filter(P.differs("attribute_set_id", legacy_set_id))
    return viewed.select("name", "entity_id", "sku")


def reconciliation_job(
    src: dict[str, DataFrame],
    tgt: dict[str, DataFrame],
    cfg: MigrationConfig,
    legacy_set_id: int,
    path: str | None = None,
    shape: str = "grouped",
) -> dict[str, DataFrame]:
    """Every legacy product with a model, with each catalogue product of the same name (or NULLs).

    ``shape="grouped"`` says it without pairing: each legacy product with its
    match count (``migration_record``), and every catalogue product whose name
    a legacy product has (``migration_record_matches``).  ``shape="pairs"`` is
    the declared record table, one row per match: its rows multiply where
    names repeat on both sides.
    """
    legacy = legacy_products(src, cfg).filter(P.present("products_model"))
    cat_names = catalogue_names(tgt, legacy_set_id)
    if shape == "grouped":
        rows, matches = reconcile_grouped(legacy, cat_names, "products_name", "name")
        return {
            "migration_record": rows.select(
                F.col("products_id").cast("long").alias("legacy_id"),
                F.col("products_model").alias("legacy_sku"),
                F.col("products_name").alias("legacy_name"),
                F.col("match_count"),
            ),
            "migration_record_matches": matches.select(
                F.col("name").alias("target_name"), F.col("entity_id").cast("long").alias("target_id"), F.col("sku").alias("target_sku")
            ),
        }
    if shape != "pairs":
        raise ValueError("shape must be 'pairs' or 'grouped'")
    matched = reconcile_by_name(legacy, cat_names, "products_name", "name", "left")
    rows = matched.select(
        F.col("products_id").alias("legacy_id"),
        F.col("products_model").alias("legacy_sku"),
        F.col("products_name").alias("legacy_name"),
        F.col("entity_id").alias("target_id"),
        F.col("sku").alias("target_sku"),
        F.col("name").alias("target_name"),
    )
    return {"migration_record": record_table(rows, MIGRATION_RECORD, path)}
