"""Product jobs: legacy products under a new attribute set, and the catalogue bootstrap.

Target tables that are read as well as written (attribute dictionary,
attribute sets, product entities, category names) arrive in ``tgt``.
Generated ids continue after the largest id among the rows that stay in the
target table (rows a run replaces do not count), so a re-run reproduces the
same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.choose import choose_row
from shopshift.operators.eav import constant_attribute, resolve_attribute_ids, wide_to_eav
from shopshift.operators.idmap import extend_id_map, refuse_conflicts, with_ids
from shopshift.operators.joins import computed_key_join, join_filtered_right
from shopshift.operators.keys import next_key
from shopshift.operators.ledger import Ledger, counted_join
from shopshift.operators.lookups import map_codes
from shopshift.plans import lookups as L
from shopshift.sinks.writers import append_union, replace_where
from shopshift.sources.tables import attribute_catalog, constant_row, materialise


#: What a catalogue entity is made from: a product, and the language in which it is described (0: the one row of a product).
ENTITY_KEY = ["products_id", "variant"]
#: The variant of a description without a language.
NO_LANGUAGE = -1


def description_rows(src: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """All description rows, their language as ``variant``."""
    d = src["products_description"]
    language = F.coalesce(F.col("language_id").cast("long"), F.lit(NO_LANGUAGE).cast("long")) if "language_id" in d.columns else F.lit(NO_LANGUAGE).cast("long")
    return d.select("products_id", language.alias("variant"), *columns)


def descriptions(src: dict[str, DataFrame], cfg: MigrationConfig, columns: list[str], per_language: bool = False) -> DataFrame:
    """Description rows, one per product (or per product and language), with ``variant`` and ``unused``.

    A shop keeps a description per language.  Of several rows the one in
    ``cfg.description_language`` is taken, else the one with the smallest
    language id (NULL last), and of one language the smallest row; ``unused``
    counts the others.  ``variant`` is 0 for the one row of a product, or the
    language id (-1 for NULL, and in a table without ``language_id``).
    """
    d = description_rows(src, columns)
    if per_language:
        return choose_row(d, ENTITY_KEY, unused_col="unused")
    wanted = F.col("variant").eqNullSafe(F.lit(cfg.description_language).cast("long"))
    return choose_row(d, ["products_id"], [~wanted, F.col("variant") == NO_LANGUAGE], "unused").withColumn("variant", F.lit(0).cast("long"))


def unused_descriptions(src: dict[str, DataFrame], cfg: MigrationConfig) -> DataFrame:
    """(products_id, variant, unused): the products with description rows that the catalogue does not take, and how many."""
    keys = ENTITY_KEY if cfg.description_mode == "each" else ENTITY_KEY[:1]
    rows = description_rows(src, []).groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("unused")).filter("unused > 0")
    return rows.select("products_id", F.col("variant") if "variant" in keys else F.lit(0).cast("long").alias("variant"), "unused")


def legacy_products(src: dict[str, DataFrame], cfg: MigrationConfig | None = None, ledger: Ledger | None = None) -> DataFrame:
    """Legacy products with their names (every product, model or not); a product with several descriptions has one name."""
    p = src["products"].select("products_id", "products_model", "products_price")
    d = descriptions(src, cfg or MigrationConfig(), ["products_name"])
    described = counted_join(ledger, "legacy products: description", p, d.select("products_id", "products_name"), "products_id")
    return described.select("products_id", "products_model", "products_name", "products_price")


def legacy_attribute_set(
    spark: SparkSession, tgt: dict[str, DataFrame], cfg: MigrationConfig
) -> tuple[dict[str, DataFrame], int, int]:
    """B3 set-up: (re)create the legacy attribute set, its group and its members.

    Returns the new tables and the new set and group ids.
    """
    sets = tgt["eav_attribute_set"]
    replaced = P.equals("attribute_set_name", cfg.legacy_set_name)
    # ids continue after the rows that stay, so a re-run reproduces the same ids
    set_id = next_key(sets.filter(~F.coalesce(replaced, F.lit(False))), "attribute_set_id")
    old_sets = sets.filter(replaced).select("attribute_set_id")
    kept = replace_where(
        sets,
        constant_row(
            spark,
            attribute_set_id=set_id,
            attribute_set_name=cfg.legacy_set_name,
            entity_type_id=cfg.product_entity_type_id,
        ),
        replaced,
    )
    # the group belongs to the set: groups of a replaced legacy set go with it
    groups = tgt["eav_attribute_group"].join(old_sets, "attribute_set_id", "left_anti")
    group_id = next_key(groups, "attribute_group_id")
    new_group = constant_row(
        spark, attribute_group_id=group_id, attribute_set_id=set_id, attribute_group_name=C.LEGACY_GROUP_NAME
    )
    members = (
        tgt["eav_attribute"]
        .filter(
            P.equals("entity_type_id", cfg.product_entity_type_id)
            & P.one_of("attribute_code", C.LEGACY_SET_MEMBER_CODES)
        )
        .select(
            "attribute_id",
            F.lit(group_id).alias("attribute_group_id"),
            F.lit(set_id).alias("attribute_set_id"),
            F.lit(cfg.product_entity_type_id).alias("entity_type_id"),
        )
    )
    out = {
        "eav_attribute_set": kept,
        "eav_attribute_group": groups.unionByName(new_group, allowMissingColumns=True),
        "eav_entity_attribute": members,
    }
    return out, set_id, group_id


def legacy_products_job(
    src: dict[str, DataFrame], tgt: dict[str, DataFrame], cfg: MigrationConfig, materialise_stages: bool = False, ledger: Ledger | None = None
) -> dict[str, DataFrame]:
    """Legacy product entities in the new set, with name, price and status values.

    The product/description join feeds four targets; ``materialise_stages``
    checkpoints it once.
    """
    spark = src["products"].sparkSession
    out, set_id, _ = legacy_attribute_set(spark, tgt, cfg)
    lp = legacy_products(src, cfg, ledger if materialise_stages else None)
    if materialise_stages:
        lp = materialise(lp, "legacy_products", ledger)
    et = cfg.product_entity_type_id
    entity = lp.select(
        F.col("products_id").alias("entity_id"),
        F.col("products_model").alias("sku"),
        F.lit(et).alias("entity_type_id"),
        F.lit(set_id).alias("attribute_set_id"),
        F.lit("simple").alias("type_id"),
    )
    consts = {"entity_type_id": et, "store_id": cfg.product_store_id}
    ints = [constant_attribute(lp, "products_id", C.LEGACY_PRODUCT_ATTR["status"], 1, consts)]
    if cfg.legacy_visibility:
        ints.append(constant_attribute(lp, "products_id", C.LEGACY_PRODUCT_ATTR["visibility"], 1, consts))
    out.update(
        {
            "catalog_product_entity": entity,
            "catalog_product_entity_varchar": wide_to_eav(
                lp, "products_id", {C.LEGACY_PRODUCT_ATTR["name"]: "products_name"}, "string", consts
            ),
            "catalog_product_entity_decimal": wide_to_eav(
                lp, "products_id", {C.LEGACY_PRODUCT_ATTR["price"]: "products_price"}, "decimal(12,4)", consts
            ),
            "catalog_product_entity_int": append_union(ints),
        }
    )
    return out


DESCRIBED = [
    "products_name",
    "products_description",
    "products_short_description",
    "products_whats_included",
    "products_compatibility",
    "products_tech_specs",
]


def catalog_products(src: dict[str, DataFrame], cfg: MigrationConfig | None = None, ledger: Ledger | None = None) -> DataFrame:
    """B11 staging: products that have a model, with a description and the image folder as type.

    One row per product, or with ``cfg.description_mode="each"`` one per
    product and language of its descriptions; ``variant`` tells them apart.
    """
    cfg = cfg or MigrationConfig()
    if cfg.description_mode not in ("one", "each"):
        raise ValueError("description_mode must be 'one' or 'each'")
    p = src["products"].filter(P.present("products_model")).select(
        "products_id", "products_model", "products_image", "products_image_med", "products_image_pop", "products_price", "products_weight"
    )
    described = descriptions(src, cfg, DESCRIBED, cfg.description_mode == "each").drop("unused")
    joined = counted_join(ledger, "catalogue: description", p, described, "products_id")
    return joined.select(
        "products_id",
        "variant",
        "products_name",
        "products_model",
        "products_description",
        "products_short_description",
        "products_whats_included",
        "products_compatibility",
        "products_tech_specs",
        "products_image",
        "products_image_med",
        "products_image_pop",
        "products_price",
        "products_weight",
        X.path_parent("products_image").alias("product_type"),
    )


def catalog_rows(
    staged: DataFrame, type_map: DataFrame, attribute_sets: DataFrame, cfg: MigrationConfig, ledger: Ledger | None = None
) -> DataFrame:
    """Staged products whose type maps to an existing attribute set, with the SKU generated from their own row and the set's id."""
    sets = attribute_sets.groupBy("attribute_set_name").agg(F.min("attribute_set_id").alias("attribute_set_id"))
    of_type = type_map.join(sets, type_map["target_set_name"] == sets["attribute_set_name"], "inner")
    # one row per type of the configured map at most
    of_type = F.broadcast(of_type.groupBy("legacy_type").agg(F.min("attribute_set_id").alias("attribute_set_id")))
    typed = counted_join(ledger, "catalogue: type", staged, of_type, staged["product_type"] == of_type["legacy_type"]).drop("legacy_type")
    return typed.withColumn("sku", X.legacy_sku("product_type", "products_name", cfg.migrate_flag))


def catalog_id_map(rows: DataFrame, first_id: int, known: DataFrame | None = None) -> DataFrame:
    """K5/K6: the id of every product (and variant) that ever had one; new ones in the order of (SKU, product id, variant)."""
    keys = rows.groupBy(*ENTITY_KEY).agg(F.min("sku").alias("sku"))
    return extend_id_map(known, keys, ENTITY_KEY, ["sku", *ENTITY_KEY], first_id)


def entity_rows(rows: DataFrame, cfg: MigrationConfig) -> DataFrame:
    """The entity columns of catalogue rows that have their ids."""
    ts = F.lit(cfg.run_timestamp).cast("timestamp_ntz")
    return rows.select(
        *ENTITY_KEY,
        "sku",
        "attribute_set_id",
        F.lit("simple").alias("type_id"),
        F.lit(cfg.product_entity_type_id).alias("entity_type_id"),
        F.lit(0).alias("has_options"),
        F.lit(0).alias("required_options"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        "entity_id",
    )


def new_catalog_entities(
    staged: DataFrame, type_map: DataFrame, attribute_sets: DataFrame, cfg: MigrationConfig, first_id: int, known: DataFrame | None = None
) -> DataFrame:
    """One new entity per staged row whose type maps to an existing attribute set, with its product id and variant.

    Products that share a type and a name get the same generated SKU and
    entities of their own; the product id, not the SKU, links a product to its
    entity.  ``known`` holds the ids of earlier runs.
    """
    rows = catalog_rows(staged, type_map, attribute_sets, cfg).select(*ENTITY_KEY, "sku", "attribute_set_id")
    return entity_rows(with_ids(rows, catalog_id_map(rows, first_id, known), ENTITY_KEY), cfg)


def category_types(type_map: DataFrame, category_names: DataFrame) -> DataFrame:
    """The type map with the ids of each type's category, written as a stage: a few rows, which the planner knows."""
    cats = category_names.select(F.col("entity_id").alias("category_id"), F.col("value").alias("category_value"), "attribute_id")
    mapped = join_filtered_right(
        type_map,
        cats,
        type_map["target_category"] == cats["category_value"],
        P.equals("attribute_id", C.CATEGORY_NAME_ATTRIBUTE_ID),
        "inner",
    )
    return materialise(mapped.select("legacy_type", "category_id"))


def product_bridge(
    staged: DataFrame, entities: DataFrame, type_map: DataFrame, category_names: DataFrame, cfg: MigrationConfig
) -> DataFrame:
    """Link staged products to the entities created for them (by product id and variant) and to their categories.

    ``entities`` are those of :func:`new_catalog_entities`, as read back.  The
    category ids are joined onto the type map first, so the products meet one
    small table and are not shuffled by their dozen of categories.
    """
    ents = entities.select(*ENTITY_KEY, "entity_id", "sku", "attribute_set_id")
    bridged = with_ids(staged, ents, ENTITY_KEY)
    return map_codes(bridged, category_types(type_map, category_names), "product_type", "legacy_type", drop_key=True)


def stored_bridge(staged: DataFrame, entities: DataFrame, cfg: MigrationConfig) -> DataFrame:
    """Staged products with the stored entities that have the SKU generated for them.

    For entities of an earlier run, which do not say whose they are; products
    sharing a type and a name all meet all entities with their SKU.
    """
    ents = entities.select("entity_id", "sku")
    return computed_key_join(staged, X.legacy_sku("product_type", "products_name", cfg.migrate_flag), ents, ents["sku"], "inner")


CATALOG_TEXT = {
    "description": "products_description",
    "short_description": "products_short_description",
    "whats_included": "products_whats_included",
    "technical_details": "products_tech_specs",
    "compatibility": "products_compatibility",
}


def catalog_values(bridge: DataFrame, attributes: DataFrame, cfg: MigrationConfig) -> dict[str, DataFrame]:
    """The ten attribute value sets, one unpivot pass per value type."""
    codes = C.CATALOG_ATTRIBUTE_CODES
    ids = resolve_attribute_ids(attribute_catalog(attributes, cfg.product_entity_type_id), codes.values())
    consts = {"entity_type_id": cfg.product_entity_type_id, "store_id": cfg.product_store_id}

    def pick(mapping: dict[str, str]) -> dict[int, str]:
        return {ids[codes[k]]: v for k, v in mapping.items() if codes[k] in ids}

    def unpivot(mapping: dict, value_type: str) -> DataFrame:
        picked = pick(mapping)
        if not picked:
            return bridge.sparkSession.createDataFrame(
                [], f"value {value_type}, attribute_id int, entity_id long, entity_type_id int, store_id int"
            )
        return wide_to_eav(bridge, "entity_id", picked, value_type, consts)

    varchar = unpivot({"name": "products_name"}, "string")
    decimal = unpivot({"price": "products_price", "weight": "products_weight"}, "decimal(12,4)")
    text = unpivot(CATALOG_TEXT, "string")
    flags = {"status": F.lit(1), "visibility": F.lit(1)}
    ints = unpivot(flags, "int")
    return {
        "catalog_product_entity_varchar": varchar,
        "catalog_product_entity_decimal": decimal,
        "catalog_product_entity_text": text,
        "catalog_product_entity_int": ints,
    }


def catalog_job(
    src: dict[str, DataFrame],
    tgt: dict[str, DataFrame],
    cfg: MigrationConfig,
    materialise_stages: bool = False,
    ledger: Ledger | None = None,
) -> dict[str, DataFrame]:
    """Classify legacy products, recreate their flagged entities, link categories, write values.

    A product that an earlier run knew keeps its entity's id
    (``catalog_product_id_map``).  New ids start at ``cfg.first_catalog_id``,
    and above every entity that stays, every id ever given and, as legacy
    products become entities under their own ids, every product id.  The rows
    with their ids are written once; entities, categories and values are read
    from that stage.
    """
    spark = src["products"].sparkSession
    type_map = L.product_type_map(spark, cfg)
    existing = tgt["catalog_product_entity"]
    flagged = P.ends_with("sku", cfg.migrate_flag)
    stays = existing.filter(~F.coalesce(flagged, F.lit(False)))
    first_id = max(next_key(stays, "entity_id"), next_key(src["products"], "products_id"), cfg.first_catalog_id)

    def found(counted: Ledger | None) -> DataFrame:
        return catalog_rows(catalog_products(src, cfg, counted), type_map, tgt["eav_attribute_set"], cfg, counted)

    # the ids need the rows' keys alone; the joins are counted where the rows are written
    id_map = catalog_id_map(found(None), first_id, tgt.get("catalog_product_id_map"))
    rows = with_ids(found(ledger if materialise_stages else None), id_map, ENTITY_KEY)
    if materialise_stages:
        rows = materialise(rows, "catalogue", ledger)  # read by the entities, the category links and four value tables
    refuse_conflicts(rows, stays, "catalogue")
    categories = category_types(type_map, tgt["catalog_category_entity_varchar"])
    linked = map_codes(rows.select("entity_id", "product_type"), categories, "product_type", "legacy_type")
    # a product in several categories has its values once, one in none has no values
    valued = rows.join(categories.select("legacy_type").distinct(), rows["product_type"] == F.col("legacy_type"), "left_semi")
    return {
        "catalog_product_entity": replace_where(existing, entity_rows(rows, cfg).drop(*ENTITY_KEY), flagged),
        "catalog_product_id_map": id_map,
        "catalog_product_description_unused": unused_descriptions(src, cfg),
        "catalog_category_product": linked.select(F.col("entity_id").alias("product_id"), "category_id", F.lit(1).alias("position")).distinct(),
        **catalog_values(valued, tgt["eav_attribute"], cfg),
    }
