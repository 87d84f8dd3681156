"""Configuration of a migration run.

Everything a run is parameterised by lives here: script-level constants,
the literal code-translation tables and the attribute ids of the target
model.  Operators never hard-code these; jobs receive a ``MigrationConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the source migration's values for the
# target data to come out right; they are configuration, not logic.
# ---------------------------------------------------------------------------

# Legacy order status id -> target order status.
ORDER_STATUS_MAP = [
    (0, "closed"),
    (1, "pending"),
    (2, "complete"),
    (3, "holded"),
    (4, "pending"),
    (5, "fraud"),
    (6, "pending"),
    (7, "canceled"),
    (8, "pending_paypal"),
]

# Legacy payment method -> target payment method.
PAYMENT_METHOD_MAP = [
    ("PayPal Express Checkout", "paypal_express"),
    ("PayPal", "paypal_express"),
    ("PayPal Direct Payment", "paypal_direct"),
    ("Credit Card", "paypal_direct"),
]

# Legacy card type -> target card type code.
CARD_TYPE_MAP = [
    ("", ""),
    ("Visa", "VI"),
    ("MasterCard", "MC"),
    ("Amex", "AE"),
    ("Discover", "DI"),
]

# Legacy product image folder -> (target attribute set name, target category name).
PRODUCT_TYPE_MAP = [
    ("accessories", "TRSDefault", "accessories"),
    ("complete-retrofit-kits", "RetroKit", "complete-retrofit-kits"),
    ("hid-component-kits", "HIDSystem", "hid-systems"),
    ("hid-systems", "HIDSystem", "hid-systems"),
    ("off-road-lighting", "TRSDefault", "trs-root"),
    ("hid-bulbs", "Bulbs", "bulbs"),
    ("hid-projectors", "Projectors", "projectors"),
    ("projector-shrouds", "Shrouds", "shrouds"),
    ("hid-ballasts", "Ballasts", "ballasts"),
    ("relay-harnesses", "Harnesses", "harnesses"),
    ("clear-lenses", "Lenses", "lenses"),
    ("bargain-basement", "TRSDefault", "closeouts"),
]

# Catalogue attribute codes (looked up by code in the attribute dictionary).
CATALOG_ATTRIBUTE_CODES = {
    "name": "name",
    "price": "price",
    "status": "status",
    "visibility": "visibility",
    "description": "description",
    "short_description": "short_description",
    "whats_included": "whats_included",
    "technical_details": "technical_addl",
    "compatibility": "compatibility_addl",
    "weight": "weight",
}

# Fixed attribute ids of the target model used by the customer/order side.
CUSTOMER_ATTR = {"firstname": 5, "lastname": 7, "default_billing": 13, "default_shipping": 14}
ADDRESS_ATTR = {
    "firstname": 20,
    "lastname": 22,
    "company": 24,
    "street": 25,
    "city": 26,
    "country_id": 27,
    "region": 28,
    "region_id": 29,
    "postcode": 30,
    "telephone": 31,
}
LEGACY_PRODUCT_ATTR = {"name": 71, "price": 75, "status": 96, "visibility": 102}
CATEGORY_NAME_ATTRIBUTE_ID = 43
MAX_REGION_ZONE_ID = 78

CUSTOMER_ENTITY_TYPE_ID = 1
ADDRESS_ENTITY_TYPE_ID = 2
PRODUCT_ENTITY_TYPE_ID = 4

LEGACY_GROUP_NAME = "Legacy Attributes"
LEGACY_SET_MEMBER_CODES = ("name", "price", "status")

# Order-total classes -> staged column names (value and, for two, title).
ORDER_TOTAL_CLASSES = {
    "ot_total": {"order_total": "value"},
    "ot_shipping": {"order_shipping_cost": "value", "order_shipping_carrier": "title"},
    "ot_subtotal": {"order_subtotal": "value"},
    "ot_discount_coupon": {"order_discount": "value", "order_discount_detail": "title"},
    "ot_tax": {"order_tax": "value"},
    "ot_refund": {"order_refund": "value"},
    "ot_insurance": {"order_insurance": "value"},
    "ot_signature": {"order_signature": "value"},
}

# Patterns for transaction amounts carried in history comments.
AMOUNT_GATE_PATTERN = r".*; \$-?[0-9]+\.[0-9][0-9].*"
CHARGE_PATTERN = r".*; \$[0-9]+.*"
COMMENT_TXN_NOTE = "Post Nov 2013 PayPal Transaction"
ORDER_TXN_NOTE = "Post Nov 2013 Credit Transaction"

PARENT_ITEM_OPTIONS = 'a:1:{s:15:"info_buyRequest";a:0:{}}'
RATING_SCALE = (1, 2, 3, 4, 5)


@dataclass(frozen=True)
class MigrationConfig:
    """Script-level parameters of one run."""

    migrate_flag: str = "FLAG"
    store_id: int = 1
    product_store_id: int = 0
    legacy_set_name: str = "Legacy"
    rating_code: str = "Rating"
    run_timestamp: str = "2013-11-01 00:00:00"
    product_entity_type_id: int = PRODUCT_ENTITY_TYPE_ID
    # of several descriptions of a product: "one" (that of the language, else of the smallest language id), or "each" language an entity
    description_mode: str = "one"
    description_language: int | None = None
    # catalogue ids start here at least; leave room below for the ids of legacy products that are still to come
    first_catalog_id: int = 1
    # one row per (key, class) is required in order totals ("error"); "min" takes the smallest, "reject" sets both aside
    on_duplicate_total: str = "error"
    # the legacy catalogue made legacy products visible only in the
    # catalogue job; the legacy-products job leaves visibility alone
    legacy_visibility: bool = False
    order_status_map: list = field(default_factory=lambda: list(ORDER_STATUS_MAP))
    payment_method_map: list = field(default_factory=lambda: list(PAYMENT_METHOD_MAP))
    card_type_map: list = field(default_factory=lambda: list(CARD_TYPE_MAP))
    product_type_map: list = field(default_factory=lambda: list(PRODUCT_TYPE_MAP))
