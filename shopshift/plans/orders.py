"""Order jobs: stage orders, stage and repair payment history, payments, order tables, items.

Inputs are legacy tables by name (``orders``, ``customers``, ``orders_total``,
``orders_products``, ``orders_products_attributes``, ``orders_status_history``,
``orders_status_history_transactions``); outputs are target frames by name.

Shuffle plan: everything is keyed by ``orders_id``.  Counts and the class
pivot are partial-aggregated before their shuffle; the lookups are literal
broadcasts; the customer dimension is joined on its own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.aggregate import group_count
from shopshift.operators.joins import join_filtered_right
from shopshift.operators.ledger import Ledger, counted_join
from shopshift.operators.lookups import map_codes
from shopshift.operators.reshape import class_pivot, role_rows
from shopshift.operators.update import pick_first, update_from
from shopshift.plans import lookups as L
from shopshift.plans.rejects import split_orders
from shopshift.sinks.writers import append_union
from shopshift.sources.tables import materialise

ADDRESS_FIELDS = ("name", "company", "street_address", "suburb", "city", "postcode", "state", "country")


def orders_stage(src: dict[str, DataFrame], cfg: MigrationConfig, ledger: Ledger | None = None) -> DataFrame:
    """One row per order with a mapped status, customer names, item count and totals by class; its joins go into ``ledger``."""
    spark = src["orders"].sparkSession
    # named here: counting rows keeps the planner from dropping columns below it
    o = src["orders"].select(
        "orders_id", "orders_status", "date_purchased", "last_modified", "customers_id", "customers_name", "customers_email_address",
        "customers_telephone", *[f"{side}_{f}" for side in ("delivery", "billing") for f in ADDRESS_FIELDS], "currency", "currency_value",
    )
    mapped = map_codes(o, L.status_map(spark, cfg), "orders_status", "legacy_status_id", ledger=ledger, step="orders: status").drop("orders_status")
    cust = src["customers"].select(
        F.col("customers_id").alias("c_customers_id"),
        F.col("customers_firstname").alias("c_firstname"),
        F.col("customers_lastname").alias("c_lastname"),
    )
    with_cust = counted_join(ledger, "orders: customer", mapped, cust, mapped["customers_id"] == cust["c_customers_id"], "left")
    first, last = X.name_with_fallback("c_firstname", "c_lastname", "customers_name")
    counts = group_count(src["orders_products"], "orders_id", "product_count")
    # rejected rows are gone by now: one that is still there twice is an error
    duplicate = "error" if cfg.on_duplicate_total == "reject" else cfg.on_duplicate_total
    totals = class_pivot(src["orders_total"], "orders_id", "class", C.ORDER_TOTAL_CLASSES, duplicate)
    staged = counted_join(ledger, "orders: item count", with_cust, counts, "orders_id", "left")
    staged = counted_join(ledger, "orders: totals", staged, totals, "orders_id", "left")
    addr = [F.col(f"{side}_{f}") for side in ("delivery", "billing") for f in ADDRESS_FIELDS]
    return staged.select(
        "orders_id",
        F.col("status").alias("orders_status"),
        "date_purchased",
        "last_modified",
        F.col("c_customers_id").alias("customers_id"),
        first.alias("customers_firstname"),
        last.alias("customers_lastname"),
        F.col("customers_email_address").alias("customers_email"),
        "customers_telephone",
        *addr,
        "product_count",
        F.col("currency").alias("currency_code"),
        "currency_value",
        *[c for outs in C.ORDER_TOTAL_CLASSES.values() for c in outs],
    )


def order_history_stage(src: dict[str, DataFrame], cfg: MigrationConfig, ledger: Ledger | None = None) -> DataFrame:
    """B5 staging: history rows of orders whose payment method and card type map, with transactions.

    The order's PayPal id and card-check responses are carried along, so
    the first repair (U1) needs no second join with the orders table.
    """
    spark = src["orders"].sparkSession
    o = src["orders"].select(
        "orders_id", "payment_method", "cc_type", "cc_owner", "cc_number", "cc_expires", "last_modified", "date_purchased", "paypal_txn_id",
        "cc_avs_response", "cc_cvv2_response",
    )
    o = map_codes(o, L.payment_map(spark, cfg), "payment_method", "legacy_method", ledger=ledger, step="history: payment method")
    o = map_codes(o, L.card_type_map(spark, cfg), "cc_type", "legacy_cc_type", ledger=ledger, step="history: card type")
    month, year = X.expiry_parts("cc_expires")
    o = o.select(
        "orders_id",
        F.col("target_cc_type").alias("cc_type"),
        "cc_owner",
        X.mask_strip("cc_number").alias("cc_last_four"),
        month.alias("cc_expire_month"),
        year.alias("cc_expire_year"),
        F.col("last_modified").alias("order_last_modified"),
        F.col("date_purchased").alias("order_date_purchased"),
        F.col("target_method").alias("payment_method"),
        F.col("paypal_txn_id").alias("o_paypal_txn_id"),
        F.col("cc_avs_response").alias("o_cc_avs_response"),
        F.col("cc_cvv2_response").alias("o_cc_cvv2_response"),
    )
    h = map_codes(
        src["orders_status_history"].select("orders_status_history_id", "orders_id", "orders_status_id", "customer_notified", "date_added", "comments"),
        L.status_map(spark, cfg), "orders_status_id", "legacy_status_id", ledger=ledger, step="history: status"
    )
    txn = src["orders_status_history_transactions"].select("orders_status_history_id", *[f"transaction_{c}" for c in ("id", "type", "amount", "avs", "cvv2", "msgs")])
    # history rows meet their transactions first, so what follows stays on orders_id
    h = counted_join(ledger, "history: transaction", h, txn, "orders_status_history_id", "left")
    staged = counted_join(ledger, "history: order", h, o, "orders_id")
    return staged.select(
        "orders_id",
        "orders_status_history_id",
        "status",
        "customer_notified",
        "cc_type",
        "cc_owner",
        "cc_last_four",
        "cc_expire_month",
        "cc_expire_year",
        "order_last_modified",
        "order_date_purchased",
        "date_added",
        "payment_method",
        "comments",
        "transaction_id",
        "transaction_type",
        "transaction_amount",
        "transaction_avs",
        "transaction_cvv2",
        "transaction_msgs",
        "o_paypal_txn_id",
        "o_cc_avs_response",
        "o_cc_cvv2_response",
    )


def repair_from_comments(history: DataFrame) -> DataFrame:
    """History rows whose comment carries an amount get a transaction parsed from it."""
    amount_type = history.schema["transaction_amount"].dataType.simpleString()
    kind, amount = X.comment_amount("comments", amount_type)
    return update_from(
        history,
        None,
        None,
        X.carries_amount("comments"),
        {
            "transaction_id": F.col("o_paypal_txn_id"),
            "transaction_type": kind,
            "transaction_amount": amount,
            "transaction_avs": F.col("o_cc_avs_response"),
            "transaction_cvv2": F.col("o_cc_cvv2_response"),
            "transaction_msgs": F.lit(C.COMMENT_TXN_NOTE),
        },
    )


def repair_from_orders(history: DataFrame, stage: DataFrame) -> DataFrame:
    """U2 (after U1): the initial pending row without a transaction becomes a CHARGE of the order total."""
    totals = stage.select("orders_id", F.col("order_total").alias("s_order_total"))
    cond = (
        P.same_value("order_date_purchased", "date_added")
        & P.equals("status", "pending")
        & P.is_missing("transaction_id")
        & P.differs("o_paypal_txn_id", "")
    )
    return update_from(
        history,
        totals,
        ["orders_id"],
        cond,
        {
            "transaction_id": F.col("o_paypal_txn_id"),
            "transaction_type": F.lit("CHARGE"),
            "transaction_amount": F.col("s_order_total"),
            "transaction_avs": F.col("o_cc_avs_response"),
            "transaction_cvv2": F.col("o_cc_cvv2_response"),
            "transaction_msgs": F.lit(C.ORDER_TXN_NOTE),
        },
    )


def order_history(src: dict[str, DataFrame], cfg: MigrationConfig, stage: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """Staged history with both repairs applied, in order."""
    return repair_from_orders(repair_from_comments(order_history_stage(src, cfg, ledger)), stage)


def payments_stage(stage: DataFrame, history: DataFrame) -> DataFrame:
    """Every staged order, with each history row that carries an amount (or one NULL row)."""
    left = stage.select("orders_id", "order_total", "order_shipping_cost", "order_insurance", "order_signature")
    right = history.drop("o_paypal_txn_id", "o_cc_avs_response", "o_cc_cvv2_response")
    return join_filtered_right(left, right, "orders_id", P.is_known("transaction_amount"), "left")


def paid_totals(history: DataFrame) -> DataFrame:
    """One CHARGE amount per order of the repaired history; several CHARGEs -> the earliest (date, history id)."""
    charges = history.filter(P.equals("transaction_type", "CHARGE") & P.is_known("transaction_amount"))
    return pick_first(charges, "orders_id", ["transaction_amount"], ["date_added", "orders_status_history_id"])


def order_payment_rows(payments: DataFrame) -> DataFrame:
    """The payment target rows."""
    ship = X.shipping_total("order_shipping_cost", "order_insurance", "order_signature")
    return payments.select(
        F.col("orders_id").alias("parent_id"),
        F.col("order_total").alias("base_amount_ordered"),
        F.col("order_total").alias("amount_ordered"),
        F.col("order_shipping_cost").alias("base_shipping_amount"),
        ship.alias("shipping_amount"),
        F.col("payment_method").alias("method"),
        "cc_type",
        F.col("cc_last_four").alias("cc_last4"),
        F.col("cc_expire_month").alias("cc_exp_month"),
        F.col("cc_expire_year").alias("cc_exp_year"),
        F.col("transaction_amount").alias("base_amount_authorized"),
        F.col("transaction_amount").alias("amount_authorized"),
        F.col("transaction_id").alias("last_trans_id"),
    )


def order_core(stage: DataFrame, paid: DataFrame, cfg: MigrationConfig) -> DataFrame:
    """B7 (+U3): the 30 mapped order columns plus the paid total from the first CHARGE."""
    ship = X.shipping_total("order_shipping_cost", "order_insurance", "order_signature")
    zero = F.lit(0).cast("decimal(12,4)")
    with_paid = stage.join(paid.withColumnRenamed("transaction_amount", "paid_amount"), "orders_id", "left")
    return with_paid.select(
        F.col("orders_id").alias("entity_id"),
        F.col("orders_id").alias("increment_id"),
        F.col("orders_status").alias("status"),
        F.lit(cfg.store_id).alias("store_id"),
        F.col("date_purchased").alias("created_at"),
        F.col("last_modified").alias("updated_at"),
        F.col("customers_id").alias("customer_id"),
        F.col("customers_firstname").alias("customer_firstname"),
        F.col("customers_lastname").alias("customer_lastname"),
        F.col("customers_email").alias("customer_email"),
        F.col("product_count").alias("total_item_count"),
        *[F.col("currency_code").alias(f"{k}_currency_code") for k in ("base", "global", "order", "store")],
        F.col("order_total").alias("base_grand_total"),
        F.col("order_total").alias("grand_total"),
        F.col("order_subtotal").alias("base_subtotal"),
        F.col("order_subtotal").alias("subtotal"),
        F.col("order_shipping_cost").alias("base_shipping_amount"),
        ship.alias("shipping_amount"),
        zero.alias("base_shipping_tax_amount"),
        zero.alias("shipping_tax_amount"),
        F.col("order_tax").alias("base_tax_amount"),
        F.col("order_tax").alias("tax_amount"),
        F.col("order_discount").alias("base_discount_amount"),
        F.col("order_discount").alias("discount_amount"),
        F.col("order_discount_detail").alias("discount_description"),
        F.col("order_refund").alias("base_total_refunded"),
        F.col("order_refund").alias("total_refunded"),
        F.col("paid_amount").alias("base_total_paid"),
        F.col("paid_amount").alias("total_paid"),
    )


def order_grid(stage: DataFrame, cfg: MigrationConfig) -> DataFrame:
    """The order summary rows."""
    return stage.select(
        F.col("orders_id").alias("entity_id"),
        F.col("orders_id").alias("increment_id"),
        F.col("orders_status").alias("status"),
        F.lit(cfg.store_id).alias("store_id"),
        F.col("date_purchased").alias("created_at"),
        F.col("last_modified").alias("updated_at"),
        F.col("customers_id").alias("customer_id"),
        F.col("delivery_name").alias("shipping_name"),
        "billing_name",
        F.col("currency_code").alias("base_currency_code"),
        F.col("currency_code").alias("order_currency_code"),
        F.col("order_total").alias("base_grand_total"),
        F.col("order_total").alias("grand_total"),
    )


def order_status_history(history: DataFrame) -> DataFrame:
    """History rows as order comments."""
    return history.select(
        F.col("orders_id").alias("parent_id"),
        F.col("orders_status_history_id").alias("entity_id"),
        F.col("comments").alias("comment"),
        "status",
        F.col("date_added").alias("created_at"),
        F.col("customer_notified").alias("is_customer_notified"),
        F.lit("order").alias("entity_name"),
    )


def order_addresses(stage: DataFrame) -> DataFrame:
    """A shipping and a billing address row per order (one pass over the stage).

    The whole name goes to ``lastname`` and the suburb is not carried, as in
    the legacy migration.
    """
    def side(p: str) -> dict:
        return {
            "lastname": f"{p}_name",
            "company": f"{p}_company",
            "street": f"{p}_street_address",
            "city": f"{p}_city",
            "postcode": f"{p}_postcode",
            "region": f"{p}_state",
        }

    return role_rows(
        stage,
        {"shipping": side("delivery"), "billing": side("billing")},
        role_col="address_type",
        keep={"email": "customers_email", "telephone": "customers_telephone", "parent_id": "orders_id"},
    )


def order_items(src: dict[str, DataFrame], cfg: MigrationConfig) -> DataFrame:
    """Bundle parent lines and their option child lines as one item table."""
    lines = src["orders_products"]
    price = F.col("products_price")
    price_cols = [
        "price", "base_price", "original_price", "base_original_price", "row_total", "base_row_total",
        "price_incl_tax", "base_price_incl_tax", "row_total_incl_tax", "base_row_total_incl_tax",
    ]
    parents = lines.select(
        F.col("orders_id").alias("order_id"),
        F.col("orders_products_id").alias("item_id"),
        F.col("products_name").alias("name"),
        F.col("products_model").alias("sku"),
        F.col("products_quantity").cast("decimal(12,4)").alias("qty_ordered"),
        F.lit("bundle").alias("product_type"),
        F.lit(C.PARENT_ITEM_OPTIONS).alias("product_options"),
        *[price.alias(c) for c in price_cols],
        F.lit(1).alias("store_id"),
    )
    opts = src["orders_products_attributes"]
    children = opts.select(
        F.col("orders_id").alias("order_id"),
        F.col("orders_products_id").alias("parent_item_id"),
        F.col("products_options_values").alias("name"),
        X.option_sku("products_options", "products_options_values").alias("sku"),
        F.lit("simple").alias("product_type"),
        X.serialized_option("products_options", "orders_products_attributes_id").alias("product_options"),
        F.lit(0).cast("decimal(12,4)").alias("qty_ordered"),
        F.lit(1).alias("store_id"),
    )
    return append_union([parents, children])


def orders_job(
    src: dict[str, DataFrame], cfg: MigrationConfig, materialise_stages: bool = False, ledger: Ledger | None = None
) -> dict[str, DataFrame]:
    """All order targets from the legacy order tables.

    The staged orders feed five targets and the repaired history three;
    ``materialise_stages`` writes each once as Parquet (shared storage, survives
    executor loss).  The joins on ``orders_id`` shuffle both sides, so that AQE
    can split the partition of an order with very many history rows.  With
    ``ledger`` the joins of both stages are counted while they are written.
    With ``cfg.on_duplicate_total="reject"`` rows that cannot be migrated are
    set aside as ``migration_rejects`` (:mod:`shopshift.plans.rejects`).
    """
    if not materialise_stages:
        ledger = None
    rejects = {}
    if cfg.on_duplicate_total == "reject":
        src, rejects["migration_rejects"] = split_orders(src, cfg)
    stage = orders_stage(src, cfg, ledger)
    if materialise_stages:
        stage = materialise(stage, "orders", ledger)
    history = order_history(src, cfg, stage, ledger)
    if materialise_stages:
        history = materialise(history, "history", ledger)
    payments = payments_stage(stage, history)
    paid = paid_totals(history)
    return {
        "sales_flat_order": order_core(stage, paid, cfg),
        "sales_flat_order_grid": order_grid(stage, cfg),
        "sales_flat_order_payment": order_payment_rows(payments),
        "sales_flat_order_status_history": order_status_history(history),
        "sales_flat_order_address": order_addresses(stage),
        "sales_flat_order_item": order_items(src, cfg),
        **rejects,
    }
