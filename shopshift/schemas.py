"""Declared schemas of the target tables (K1): what a write must have.

Names are fixed values of the target data model.  Integers are bigint and
amounts decimal(14,4); narrower input is widened, anything else fails the write.
"""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "customer_entity": (
        "entity_id bigint, email string, is_active bigint, website_id bigint, group_id bigint, store_id "
        "bigint, entity_type_id bigint"
    ),
    "customer_entity_varchar": "value string, attribute_id bigint, entity_id bigint, entity_type_id bigint",
    "customer_address_entity": "entity_id bigint, parent_id bigint, entity_type_id bigint, attribute_set_id bigint, is_active bigint",
    "customer_entity_int": "value bigint, attribute_id bigint, entity_id bigint, entity_type_id bigint",
    "customer_address_entity_varchar": "value string, attribute_id bigint, entity_id bigint, entity_type_id bigint",
    "customer_address_entity_text": "value string, attribute_id bigint, entity_id bigint, entity_type_id bigint",
    "customer_address_entity_int": "value bigint, attribute_id bigint, entity_id bigint, entity_type_id bigint",
    "sales_flat_order": (
        "entity_id bigint, increment_id bigint, status string, store_id bigint, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, customer_id bigint, customer_firstname string, customer_lastname string, "
        "customer_email string, total_item_count bigint, base_currency_code string, global_currency_code "
        "string, order_currency_code string, store_currency_code string, base_grand_total decimal(14,4), "
        "grand_total decimal(14,4), base_subtotal decimal(14,4), subtotal decimal(14,4), base_shipping_amount "
        "decimal(14,4), shipping_amount decimal(14,4), base_shipping_tax_amount decimal(14,4), "
        "shipping_tax_amount decimal(14,4), base_tax_amount decimal(14,4), tax_amount decimal(14,4), "
        "base_discount_amount decimal(14,4), discount_amount decimal(14,4), discount_description string, "
        "base_total_refunded decimal(14,4), total_refunded decimal(14,4), base_total_paid decimal(14,4), "
        "total_paid decimal(14,4)"
    ),
    "sales_flat_order_grid": (
        "entity_id bigint, increment_id bigint, status string, store_id bigint, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, customer_id bigint, shipping_name string, billing_name string, "
        "base_currency_code string, order_currency_code string, base_grand_total decimal(14,4), grand_total "
        "decimal(14,4)"
    ),
    "sales_flat_order_payment": (
        "parent_id bigint, base_amount_ordered decimal(14,4), amount_ordered decimal(14,4), "
        "base_shipping_amount decimal(14,4), shipping_amount decimal(14,4), method string, cc_type string, "
        "cc_last4 string, cc_exp_month string, cc_exp_year string, base_amount_authorized decimal(14,4), "
        "amount_authorized decimal(14,4), last_trans_id string"
    ),
    "sales_flat_order_status_history": (
        "parent_id bigint, entity_id bigint, comment string, status string, created_at timestamp_ntz, "
        "is_customer_notified bigint, entity_name string"
    ),
    "sales_flat_order_address": (
        "email string, telephone string, parent_id bigint, lastname string, company string, street string, "
        "city string, postcode string, region string, address_type string"
    ),
    "sales_flat_order_item": (
        "order_id bigint, item_id bigint, name string, sku string, qty_ordered decimal(14,4), product_type "
        "string, product_options string, price decimal(14,4), base_price decimal(14,4), original_price "
        "decimal(14,4), base_original_price decimal(14,4), row_total decimal(14,4), base_row_total "
        "decimal(14,4), price_incl_tax decimal(14,4), base_price_incl_tax decimal(14,4), row_total_incl_tax "
        "decimal(14,4), base_row_total_incl_tax decimal(14,4), store_id bigint, parent_item_id bigint"
    ),
    "catalog_product_entity": (
        "entity_id bigint, sku string, attribute_set_id bigint, type_id string, entity_type_id bigint, "
        "has_options bigint, required_options bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "catalog_product_id_map": "products_id bigint, variant bigint, entity_id bigint",
    "catalog_product_description_unused": "products_id bigint, variant bigint, unused bigint",
    "catalog_category_product": "product_id bigint, category_id bigint, position bigint",
    "catalog_product_entity_varchar": "value string, attribute_id bigint, entity_id bigint, entity_type_id bigint, store_id bigint",
    "catalog_product_entity_decimal": "value decimal(14,4), attribute_id bigint, entity_id bigint, entity_type_id bigint, store_id bigint",
    "catalog_product_entity_text": "value string, attribute_id bigint, entity_id bigint, entity_type_id bigint, store_id bigint",
    "catalog_product_entity_int": "value bigint, attribute_id bigint, entity_id bigint, entity_type_id bigint, store_id bigint",
    "eav_attribute_set": "attribute_set_id bigint, attribute_set_name string, entity_type_id bigint",
    "eav_attribute_group": "attribute_set_id bigint, attribute_group_id bigint, attribute_group_name string",
    "eav_entity_attribute": "attribute_id bigint, attribute_group_id bigint, attribute_set_id bigint, entity_type_id bigint",
    "rating": "rating_id bigint, rating_code string, entity_id bigint, position bigint",
    "rating_option": "rating_id bigint, option_id bigint, code string, value bigint, position bigint",
    "review": (
        "review_id bigint, created_at timestamp_ntz, entity_pk_value bigint, entity_id bigint, status_id "
        "bigint"
    ),
    "rating_option_vote": (
        "customer_id bigint, option_id bigint, review_id bigint, value string, percent bigint, "
        "entity_pk_value bigint"
    ),
    "review_detail": "review_id bigint, store_id bigint, detail string, nickname string, customer_id bigint",
    "review_store": "review_id bigint, store_id bigint",
    "migration_record": "legacy_id bigint, legacy_sku string, legacy_name string, match_count bigint",
    "migration_rejects": "source string, row_key string, reasons string, detail string",
    "migration_ledger": "step string, rows_in bigint, rows_out bigint, dropped bigint, multiplied bigint",
    "migration_record_matches": "target_name string, target_id bigint, target_sku string",
}

#: Key columns of the target tables, and which table's key another one's columns are.
PRIMARY_KEYS = {
    "customer_entity": ["entity_id"],
    "customer_address_entity": ["entity_id"],
    "sales_flat_order": ["entity_id"],
    "sales_flat_order_grid": ["entity_id"],
    "sales_flat_order_status_history": ["entity_id"],
    "sales_flat_order_address": ["parent_id", "address_type"],
    "catalog_product_entity": ["entity_id"],
    "catalog_category_product": ["category_id", "product_id"],
    "catalog_product_entity_varchar": ["entity_id", "attribute_id", "store_id"],
    "catalog_product_entity_decimal": ["entity_id", "attribute_id", "store_id"],
    "catalog_product_entity_text": ["entity_id", "attribute_id", "store_id"],
    "catalog_product_entity_int": ["entity_id", "attribute_id", "store_id"],
    "eav_attribute_set": ["attribute_set_id"],
    "eav_attribute_group": ["attribute_group_id"],
    "review": ["review_id"],
    "review_store": ["review_id", "store_id"],
}
FOREIGN_KEYS = [
    ("customer_entity_varchar", ["entity_id"], "customer_entity"),
    ("customer_entity_int", ["entity_id"], "customer_entity"),
    ("customer_address_entity", ["parent_id"], "customer_entity"),
    ("customer_address_entity_varchar", ["entity_id"], "customer_address_entity"),
    ("customer_address_entity_text", ["entity_id"], "customer_address_entity"),
    ("customer_address_entity_int", ["entity_id"], "customer_address_entity"),
    ("sales_flat_order_grid", ["entity_id"], "sales_flat_order"),
    ("sales_flat_order_payment", ["parent_id"], "sales_flat_order"),
    ("sales_flat_order_status_history", ["parent_id"], "sales_flat_order"),
    ("sales_flat_order_address", ["parent_id"], "sales_flat_order"),
    ("sales_flat_order_item", ["order_id"], "sales_flat_order"),
    ("catalog_product_entity", ["attribute_set_id"], "eav_attribute_set"),
    ("catalog_category_product", ["product_id"], "catalog_product_entity"),
    *[(f"catalog_product_entity_{t}", ["entity_id"], "catalog_product_entity") for t in ("varchar", "decimal", "text", "int")],
    ("eav_entity_attribute", ["attribute_set_id"], "eav_attribute_set"),
    ("review_detail", ["review_id"], "review"),
    ("review_store", ["review_id"], "review"),
    ("rating_option_vote", ["review_id"], "review"),
]


def target_schema(name: str) -> T.StructType:
    """The declared schema of a target table (needs a running session)."""
    return T.StructType.fromDDL(_DDL[name])
