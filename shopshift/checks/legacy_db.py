"""A complete legacy database (and target catalogue) derived from the shared test tables.

Used to run the whole migration end to end (``plans.run.migrate``) on data
that grows with the scale factor: the same stand-ins the checks use, with one
customers table carrying every column the jobs read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.checks import standins as S
from shopshift.checks.catalog_checks import EXISTING_IDS, _existing_entities, _type_frames, product_src
from shopshift.checks.registry import address_src
from shopshift.checks.order_checks import order_src
from shopshift.checks.review_checks import review_src, review_tgt


def legacy_tables(t: S.Tables) -> dict[str, DataFrame]:
    out = dict(order_src(t))
    addr = address_src(t)
    out.update({k: addr[k] for k in ("address_book", "zones", "countries")})
    out.update(product_src(t))
    # descriptions in a second language, which a run that names none leaves unused
    first = out["products_description"].withColumn("language_id", F.lit(1).cast("long"))
    second = first.filter(F.col("products_id") % 3 == 0).withColumn("language_id", F.lit(2).cast("long"))
    out["products_description"] = first.unionByName(second.withColumn("products_name", F.concat(F.lit("Aa "), F.col("products_name"))))
    out.update(review_src(t))
    c = t.customer
    k = F.col("c_custkey")
    out["customers"] = c.select(
        k.alias("customers_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("customers_email_address"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("customers_firstname"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("customers_lastname"),
        (F.lit(900000) + k).alias("customers_default_address_id"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), k.cast("string")).alias("customers_telephone"),
    )
    return out


def target_tables(t: S.Tables) -> dict[str, DataFrame]:
    spark = t.spark
    _, sets, cats = _type_frames(t)
    codes = sorted(set(C.CATALOG_ATTRIBUTE_CODES.values()) | set(C.LEGACY_SET_MEMBER_CODES))
    attrs = spark.createDataFrame(
        [(700 + i, code, C.PRODUCT_ENTITY_TYPE_ID) for i, code in enumerate(codes)],
        "attribute_id int, attribute_code string, entity_type_id int",
    ).unionByName(S.v_attributes(t))
    existing = _existing_entities(t)
    names = t.part.select(
        F.col("p_name").alias("value"),
        F.lit(C.LEGACY_PRODUCT_ATTR["name"]).alias("attribute_id"),
        (F.lit(EXISTING_IDS) + F.col("p_partkey")).cast("long").alias("entity_id"),
        F.lit(C.PRODUCT_ENTITY_TYPE_ID).alias("entity_type_id"),
        F.lit(0).alias("store_id"),
    )
    out = {
        "eav_attribute": attrs,
        "eav_attribute_set": sets.select("attribute_set_id", "attribute_set_name", F.lit(4).alias("entity_type_id")),
        "eav_attribute_group": sets.select(
            (F.col("attribute_set_id") + 100).alias("attribute_group_id"),
            "attribute_set_id",
            F.lit("General").alias("attribute_group_name"),
        ),
        "catalog_product_entity": existing,
        "catalog_product_entity_varchar": names,
        "catalog_category_entity_varchar": cats,
    }
    out.update(review_tgt(t))
    return out


def type_map_config(t: S.Tables) -> C.MigrationConfig:
    """A run configuration whose product-type map covers the stand-in image folders (one type left out)."""
    tmap, _, _ = _type_frames(t)
    rows = [tuple(r) for r in tmap.orderBy("legacy_type").collect()]  # one row per product type: bounded
    return C.MigrationConfig(product_type_map=rows)


def write_legacy_db(spark: SparkSession, sf_dir: str, legacy_base: str, target_base: str) -> C.MigrationConfig:
    """Write the legacy tables and the target inputs as Parquet; returns the matching run configuration."""
    t = S.Tables(spark, sf_dir)
    for name, df in legacy_tables(t).items():
        df.write.mode("overwrite").parquet(os.path.join(legacy_base, f"{name}.parquet"))
    for name, df in target_tables(t).items():
        df.write.mode("overwrite").parquet(os.path.join(target_base, f"{name}.parquet"))
    return type_map_config(t)
