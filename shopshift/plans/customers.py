"""Customer jobs: customer entities and names, address entities and values, default addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.aggregate import distinct_rows
from shopshift.operators.eav import wide_to_eav
from shopshift.operators.joins import star_join
from shopshift.operators.reshape import replicate
from shopshift.sources.tables import materialise


def customers_job(src: dict[str, DataFrame], cfg: MigrationConfig) -> dict[str, DataFrame]:
    """B1: customer entities plus first and last name values (one scan for both names)."""
    cust = src["customers"]
    entity = cust.select(
        F.col("customers_id").alias("entity_id"),
        F.col("customers_email_address").alias("email"),
        F.lit(1).alias("is_active"),
        F.lit(1).alias("website_id"),
        F.lit(1).alias("group_id"),
        F.lit(cfg.store_id).alias("store_id"),
        F.lit(C.CUSTOMER_ENTITY_TYPE_ID).alias("entity_type_id"),
    )
    names = wide_to_eav(
        cust,
        "customers_id",
        {C.CUSTOMER_ATTR["firstname"]: "customers_firstname", C.CUSTOMER_ATTR["lastname"]: "customers_lastname"},
        "string",
        {"entity_type_id": C.CUSTOMER_ENTITY_TYPE_ID},
    )
    return {"customer_entity": entity, "customer_entity_varchar": names}


def addresses_stage(src: dict[str, DataFrame]) -> DataFrame:
    """B2 staging: address ⋈ customer ⋈ zone ⋈ country (inner: unmatched addresses drop)."""
    ab = src["address_book"]
    c = src["customers"].select(
        F.col("customers_id").alias("c_customers_id"), "customers_default_address_id", "customers_telephone"
    )
    z = src["zones"].select("zone_id", "zone_name")
    cn = src["countries"].select("countries_id", F.col("countries_iso_code_2").alias("country_code"))
    joined = ab.join(c, ab["customers_id"] == c["c_customers_id"], "inner")
    joined = star_join(
        joined,
        [
            (z, joined["entry_zone_id"] == z["zone_id"], "inner"),
            (cn, F.col("entry_country_id") == cn["countries_id"], "inner"),
        ],
    )
    return joined.select(
        "address_book_id",
        "customers_id",
        "customers_default_address_id",
        "entry_company",
        "entry_firstname",
        "entry_lastname",
        "entry_street_address",
        "entry_suburb",
        "entry_postcode",
        "entry_city",
        "zone_name",
        "zone_id",
        "country_code",
        "customers_telephone",
    )


ADDRESS_VARCHAR = {
    "firstname": "entry_firstname",
    "lastname": "entry_lastname",
    "company": "entry_company",
    "city": "entry_city",
    "region": "zone_name",
    "country_id": "country_code",
    "postcode": "entry_postcode",
    "telephone": "customers_telephone",
}


def address_values(stage: DataFrame) -> dict[str, DataFrame]:
    """B2 values: eight text attributes in one pass, the street text, and the region id (zones up to 78)."""
    et = {"entity_type_id": C.ADDRESS_ENTITY_TYPE_ID}
    varchar = wide_to_eav(
        stage, "address_book_id", {C.ADDRESS_ATTR[k]: v for k, v in ADDRESS_VARCHAR.items()}, "string", et
    )
    text = wide_to_eav(
        stage,
        "address_book_id",
        {C.ADDRESS_ATTR["street"]: X.street_lines("entry_street_address", "entry_suburb")},
        "string",
        et,
    )
    region = wide_to_eav(
        stage.filter(P.at_most("zone_id", C.MAX_REGION_ZONE_ID)),
        "address_book_id",
        {C.ADDRESS_ATTR["region_id"]: "zone_id"},
        "int",
        et,
    )
    return {
        "customer_address_entity_varchar": varchar,
        "customer_address_entity_text": text,
        "customer_address_entity_int": region,
    }


def default_addresses(stage: DataFrame) -> DataFrame:
    """B2 links: default billing and shipping address of each customer that has a staged address.

    One distinct over (address, customer) feeds both attributes, instead of a
    distinct scan per attribute.
    """
    pairs = distinct_rows(
        stage, [F.col("customers_default_address_id").alias("value"), F.col("customers_id").alias("entity_id")]
    )
    links = replicate(
        pairs, "attribute_id", [C.CUSTOMER_ATTR["default_billing"], C.CUSTOMER_ATTR["default_shipping"]]
    )
    return links.select(
        "value", "attribute_id", "entity_id", F.lit(C.CUSTOMER_ENTITY_TYPE_ID).alias("entity_type_id")
    )


def addresses_job(src: dict[str, DataFrame], cfg: MigrationConfig, materialise_stages: bool = False) -> dict[str, DataFrame]:
    """B2: address entities, their values and the customers' default-address links.

    The staged join feeds five targets; ``materialise_stages`` checkpoints it
    once instead of recomputing the four-way join per target.
    """
    stage = addresses_stage(src)
    if materialise_stages:
        stage = materialise(stage)
    entity = stage.select(
        F.col("address_book_id").alias("entity_id"),
        F.col("customers_id").alias("parent_id"),
        F.lit(C.ADDRESS_ENTITY_TYPE_ID).alias("entity_type_id"),
        F.lit(0).alias("attribute_set_id"),
        F.lit(1).alias("is_active"),
    )
    out = {"customer_address_entity": entity, "customer_entity_int": default_addresses(stage)}
    out.update(address_values(stage))
    return out
