"""Migration jobs end to end on hand-made legacy tables (edge cases of the legacy data)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopshift.config import MigrationConfig
from shopshift.plans import customers as CU
from shopshift.plans import orders as O
from shopshift.plans import products as PR
from shopshift.plans import reviews as RV
from shopshift.plans.reconcile import reconciliation_job
from shopshift.plans.run import migrate
from shopshift.sources.tables import read_table

CFG = MigrationConfig()
D = Decimal
T0 = dt.datetime(2013, 5, 1, 10, 0)
T1 = dt.datetime(2013, 5, 2, 10, 0)

ORDER_COLS = (
    "orders_id long, orders_status int, date_purchased timestamp_ntz, last_modified timestamp_ntz, customers_id long, "
    "customers_name string, customers_email_address string, customers_telephone string, "
    + ", ".join(f"{s}_{f} string" for s in ("delivery", "billing") for f in O.ADDRESS_FIELDS)
    + ", currency string, currency_value decimal(14,6), payment_method string, cc_type string, cc_owner string, "
    "cc_number string, cc_expires string, paypal_txn_id string, cc_avs_response string, cc_cvv2_response string"
)


def order_row(oid, status, cust, name, pay="PayPal", cc="Visa", number="XXXXXXXXXXXX1234", exp="0314", txn="PP1"):
    addr = [f"{s}-{f}-{oid}" for s in ("d", "b") for f in O.ADDRESS_FIELDS]
    return (oid, status, T0, T1, cust, name, f"{oid}@x", "555", *addr, "USD", D("1"), pay, cc, "Owner", number, exp,
            txn, "Y", "M")


@pytest.fixture(scope="module")
def src(spark):
    orders = spark.createDataFrame(
        [
            order_row(1, 1, 10, "Ann Lee"),  # pending, known customer
            order_row(2, 2, 99, "Cher"),  # guest (no customer row), name without space
            order_row(3, 42, 10, "Bo Ray"),  # unmapped status -> dropped from the stage
            order_row(4, 2, 11, "Al B Cee", pay="Cheque"),  # unmapped payment -> no history rows
            order_row(5, 1, 11, "Di Do", cc="", txn=""),  # card type '' maps; empty PayPal id
            order_row(6, 1, 11, "Ed Eh", cc=None),  # NULL card type -> no history rows
        ],
        ORDER_COLS,
    )
    customers = spark.createDataFrame(
        [(10, "ann@x", "Ann", "Lee", 100, "555-10"), (11, "cus@x", None, None, 101, "555-11")],
        "customers_id long, customers_email_address string, customers_firstname string, customers_lastname string, "
        "customers_default_address_id long, customers_telephone string",
    )
    totals = spark.createDataFrame(
        [(1, "ot_total", D("20"), "Total"), (1, "ot_shipping", D("5"), "UPS"), (1, "ot_insurance", D("1"), "Ins"),
         (2, "ot_total", D("7"), "Total"), (5, "ot_total", D("9"), "Total"), (6, "ot_total", D("3"), "Total")],
        "orders_id long, class string, value decimal(12,4), title string",
    )
    products = spark.createDataFrame(
        [(1, 1, "Kit", "K1", 2, D("10")), (1, 2, "Bulb", "B1", 1, D("5")), (2, 3, "Kit", "K1", 1, D("10"))],
        "orders_id long, orders_products_id long, products_name string, products_model string, "
        "products_quantity int, products_price decimal(12,4)",
    )
    attrs = spark.createDataFrame(
        [(1, 1, 7, "Colour", "Dark Red"), (1, 1, 8, "Größe", "L"), (2, 3, 9, "", "x")],
        "orders_id long, orders_products_id long, orders_products_attributes_id long, products_options string, "
        "products_options_values string",
    )
    history = spark.createDataFrame(
        [
            (100, 1, 1, 1, T0, "created"),  # pending on the purchase date, no transaction -> CHARGE of total
            (101, 1, 2, 0, T1, "paid (ref; $12.50)"),  # amount in comment
            (102, 1, 2, 0, T1, "refund (x; $-6.55)"),  # negative amount
            (103, 2, 2, 0, T1, "(a) x; $1.00)"),  # gate passes, amount unparsable -> NULL amount
            (104, 4, 1, 0, T0, "created"),  # order with unmapped payment method
            (105, 5, 1, 0, T0, "created"),  # empty PayPal id -> not filled
            (106, 1, 2, 0, T1, "paid again (y; $3.00)"),  # second CHARGE, later id
        ],
        "orders_status_history_id long, orders_id long, orders_status_id int, customer_notified int, "
        "date_added timestamp_ntz, comments string",
    )
    txn = spark.createDataFrame(
        [(105, "T5", "CHARGE", D("9.00"), "A", "B", "old")],
        "orders_status_history_id long, transaction_id string, transaction_type string, "
        "transaction_amount decimal(12,2), transaction_avs string, transaction_cvv2 string, transaction_msgs string",
    )
    address_book = spark.createDataFrame(
        [(100, 10, "Co", "Ann", "Lee", "1 Main", "", "12345", "Town", 78, 1),
         (101, 11, None, "Cu", "S", "2 Side", "Sub", "999", "City", 79, 1),
         (102, 11, None, "Cu", "S", "3 Side", None, "999", "City", 5, 2)],  # country 2 unknown -> dropped
        "address_book_id long, customers_id long, entry_company string, entry_firstname string, entry_lastname string, "
        "entry_street_address string, entry_suburb string, entry_postcode string, entry_city string, "
        "entry_zone_id int, entry_country_id int",
    )
    zones = spark.createDataFrame([(78, "Zone78"), (79, "Zone79"), (5, "Zone5")], "zone_id int, zone_name string")
    countries = spark.createDataFrame([(1, "US")], "countries_id int, countries_iso_code_2 string")
    return {
        "orders": orders, "customers": customers, "orders_total": totals, "orders_products": products,
        "orders_products_attributes": attrs, "orders_status_history": history,
        "orders_status_history_transactions": txn, "address_book": address_book, "zones": zones,
        "countries": countries,
    }


def test_orders_stage(spark, src):
    st = {r["orders_id"]: r for r in O.orders_stage(src, CFG).collect()}
    assert sorted(st) == [1, 2, 4, 5, 6]  # status 42 unmapped
    assert (st[1]["customers_firstname"], st[1]["customers_lastname"]) == ("Ann", "Lee")
    assert st[2]["customers_id"] is None and (st[2]["customers_firstname"], st[2]["customers_lastname"]) == ("", "Cher")
    assert (st[4]["customers_firstname"], st[4]["customers_lastname"]) == ("Al", "B Cee")
    assert st[1]["product_count"] == 2 and st[4]["product_count"] is None
    assert st[1]["order_total"] == D("20") and st[1]["order_shipping_carrier"] == "UPS" and st[2]["order_tax"] is None


def test_rows_that_cannot_be_migrated_are_set_aside(spark, src):
    import json
    from dataclasses import replace

    own = dict(src)
    own["orders_total"] = src["orders_total"].unionByName(src["orders_total"].filter("orders_id = 1 and class = 'ot_total'").withColumn("value", F.lit(D("21")).cast("decimal(12,4)")))
    long = src["orders_products"].filter("orders_products_id = 1").withColumn("products_name", F.repeat(F.lit("x"), F.lit(256))).withColumn("orders_products_id", F.lit(99).cast("long"))
    own["orders_products"] = src["orders_products"].unionByName(long)
    out = O.orders_job(own, replace(CFG, on_duplicate_total="reject"), materialise_stages=True)
    got = {(r["source"], r["row_key"], r["reasons"]): json.loads(r["detail"]) for r in out["migration_rejects"].collect()}
    assert sorted(got) == [("orders_products", "99", "long name"), ("orders_status_history", "103", "unreadable amount"), ("orders_total", "1", "repeated class")]
    assert out["migration_rejects"].filter("source = 'orders_total'").count() == 2  # both rows of the class
    assert got["orders_products", "99", "long name"]["products_name"] == "x" * 256
    orders = {r["entity_id"]: r for r in out["sales_flat_order"].collect()}
    assert orders[1]["grand_total"] is None and orders[1]["shipping_amount"] is not None and orders[2]["grand_total"] == D("7")
    assert 103 not in {r["entity_id"] for r in out["sales_flat_order_status_history"].collect()}
    assert 99 not in {r["item_id"] for r in out["sales_flat_order_item"].collect()}


def test_duplicate_total_class_fails(spark, src):
    dup = dict(src)
    dup["orders_total"] = src["orders_total"].unionByName(src["orders_total"].limit(1))
    with pytest.raises(Exception, match="several rows of class"):
        O.orders_stage(dup, CFG).collect()


def test_history_repairs_in_order(spark, src):
    stage = O.orders_stage(src, CFG)
    h = {r["orders_status_history_id"]: r for r in O.order_history(src, CFG, stage).collect()}
    assert sorted(h) == [100, 101, 102, 103, 105, 106]  # order 4 (Cheque) and 6 (NULL card) have none
    assert (h[100]["transaction_type"], h[100]["transaction_amount"]) == ("CHARGE", D("20.00"))
    assert h[100]["transaction_msgs"] == "Post Nov 2013 Credit Transaction"
    assert (h[101]["transaction_type"], h[101]["transaction_amount"], h[101]["transaction_id"]) == ("CHARGE", D("12.50"), "PP1")
    assert (h[102]["transaction_type"], h[102]["transaction_amount"]) == ("REFUND", D("-6.55"))
    assert h[103]["transaction_type"] == "CHARGE" and h[103]["transaction_amount"] is None
    assert h[105]["transaction_id"] == "T5" and h[105]["transaction_msgs"] == "old"  # kept: PayPal id empty
    assert h[101]["cc_last_four"] == "1234" and (h[101]["cc_expire_month"], h[101]["cc_expire_year"]) == ("03", "2014")
    assert h[105]["cc_type"] == ""


def test_payments_and_paid_total(spark, src):
    out = O.orders_job(src, CFG)
    pay = out["sales_flat_order_payment"].collect()
    by_order = {}
    for r in pay:
        by_order.setdefault(r["parent_id"], []).append(r)
    assert len(by_order[1]) == 4  # 100, 101, 102, 106 carry amounts
    assert len(by_order[2]) == 1 and by_order[2][0]["method"] is None  # amount NULL -> one NULL payment row
    assert by_order[1][0]["shipping_amount"] == D("6.0000")  # shipping 5 + insurance 1
    core = {r["entity_id"]: r for r in out["sales_flat_order"].collect()}
    assert core[1]["total_paid"] == D("20.00")  # earliest CHARGE (T0, id 100)
    assert core[2]["total_paid"] is None and core[5]["total_paid"] == D("9.00")
    assert len(core) == 5


def test_order_addresses_and_items(spark, src):
    out = O.orders_job(src, CFG)
    addr = out["sales_flat_order_address"].collect()
    assert len(addr) == 2 * 5 and {r["address_type"] for r in addr} == {"shipping", "billing"}
    items = out["sales_flat_order_item"].collect()
    assert len(items) == 3 + 3
    child = [r for r in items if r["parent_item_id"] == 1 and r["sku"] == "Legacy-Colour-Dark-Red"]
    assert child and child[0]["product_type"] == "simple"


def test_addresses_job(spark, src):
    out = CU.addresses_job(src, CFG)
    assert out["customer_address_entity"].count() == 2  # country 2 unknown
    assert out["customer_address_entity_varchar"].count() == 2 * 8
    assert [r["value"] for r in out["customer_address_entity_int"].collect()] == [78]
    streets = sorted(r["value"] for r in out["customer_address_entity_text"].collect())
    assert streets == ["1 Main", "2 Side\nSub"]
    links = sorted(tuple(r) for r in out["customer_entity_int"].collect())
    assert links == [(100, 13, 10, 1), (100, 14, 10, 1), (101, 13, 11, 1), (101, 14, 11, 1)]


def test_customers_job(spark, src):
    out = CU.customers_job(src, CFG)
    assert out["customer_entity"].count() == 2
    names = out["customer_entity_varchar"].collect()
    assert len(names) == 4 and sum(r["value"] is None for r in names) == 2


@pytest.fixture(scope="module")
def catalog(spark):
    products = spark.createDataFrame(
        [(1, "M1", D("10"), "img/hid-bulbs/a.jpg", D("1")), (2, "M2", D("20"), "hid-bulbs/b.jpg", D("2")),
         (3, None, D("30"), "img/hid-bulbs/c.jpg", D("3")), (4, "", D("40"), "x.jpg", D("4")),
         (5, "M5", D("50"), "img/unknown/e.jpg", D("5")), (6, "M6", D("60"), "img/hid-bulbs/f.jpg", D("6"))],
        "products_id long, products_model string, products_price decimal(12,4), products_image string, "
        "products_weight decimal(12,4)",
    ).selectExpr("*", "cast(null as string) as products_image_med", "cast(null as string) as products_image_pop")
    desc = spark.createDataFrame(
        [(i, n, f"long {i}", f"short {i}", None, "fits", "specs") for i, n in
         [(1, "Bulb A"), (2, "Bulb B"), (3, "Bulb C"), (4, "Bulb D"), (5, "Bulb E"), (6, "Bulb A")]],
        "products_id long, products_name string, products_description string, products_short_description string, "
        "products_whats_included string, products_compatibility string, products_tech_specs string",
    )
    tgt = {
        "eav_attribute": spark.createDataFrame(
            [(71, "name", 4), (75, "price", 4), (96, "status", 4), (102, "visibility", 4), (80, "weight", 4),
             (81, "description", 4), (82, "short_description", 4), (83, "whats_included", 4),
             (84, "technical_addl", 4), (85, "compatibility_addl", 4), (5, "firstname", 1)],
            "attribute_id int, attribute_code string, entity_type_id int"),
        "eav_attribute_set": spark.createDataFrame([(9, "Bulbs", 4), (3, "Legacy", 4)],
                                                   "attribute_set_id int, attribute_set_name string, entity_type_id int"),
        "eav_attribute_group": spark.createDataFrame([(20, 9, "General")],
                                                     "attribute_group_id int, attribute_set_id int, attribute_group_name string"),
        "catalog_product_entity": spark.createDataFrame(
            [(500, "old-FLAG", 9), (501, "real", 9)], "entity_id long, sku string, attribute_set_id int"),
        "catalog_product_entity_varchar": spark.createDataFrame(
            [("Bulb A", 71, 501, 4, 0), ("Bulb A", 71, 900, 4, 0)],
            "value string, attribute_id int, entity_id long, entity_type_id int, store_id int"),
        "catalog_category_entity_varchar": spark.createDataFrame(
            [(40, "bulbs", 43), (41, "bulbs", 44)], "entity_id long, value string, attribute_id int"),
    }
    return {"products": products, "products_description": desc}, tgt


def test_catalog_job(spark, catalog):
    src, tgt = catalog
    out = PR.catalog_job(src, tgt, CFG)
    ents = {r["sku"]: r for r in out["catalog_product_entity"].collect()}
    assert "old-FLAG" not in ents and "real" in ents
    assert set(ents) == {"real", "hid-bulbs-Bulb A-FLAG", "hid-bulbs-Bulb B-FLAG"}
    # one entity for each of products 1, 6 (same SKU) and 2, in the order of SKU and product
    assert sorted((r["entity_id"], r["sku"]) for r in out["catalog_product_entity"].collect() if r["sku"] != "real") == [
        (502, "hid-bulbs-Bulb A-FLAG"), (503, "hid-bulbs-Bulb A-FLAG"), (504, "hid-bulbs-Bulb B-FLAG")
    ]
    links = out["catalog_category_product"].collect()
    assert len(links) == 3 and {r["category_id"] for r in links} == {40}  # products 1, 2, 6; not the attribute-44 row
    assert out["catalog_product_entity_text"].count() == 3 * 5
    assert out["catalog_product_entity_decimal"].count() == 3 * 2
    assert out["catalog_product_entity_int"].count() == 3 * 2


def test_legacy_products_and_reconciliation(spark, catalog):
    src, tgt = catalog
    out = PR.legacy_products_job(src, tgt, CFG)
    sets = {r["attribute_set_name"]: r["attribute_set_id"] for r in out["eav_attribute_set"].collect()}
    assert sets == {"Bulbs": 9, "Legacy": 10}
    assert sorted(r["attribute_id"] for r in out["eav_entity_attribute"].collect()) == [71, 75, 96]
    assert out["catalog_product_entity"].count() == 6
    rec = reconciliation_job(src, tgt, CFG, legacy_set_id=10, shape="pairs")["migration_record"].collect()
    by_legacy = {}
    for r in rec:
        by_legacy.setdefault(r["legacy_id"], []).append(r["target_id"])
    assert sorted(by_legacy) == [1, 2, 5, 6]  # models present
    assert by_legacy[1] == [501] and by_legacy[2] == [None]  # entity 900 has no entity row -> rejected


def test_reviews_job(spark):
    reviews = spark.createDataFrame(
        [(1, 7, 10, "Ann", "5", T0), (2, 7, 11, "Bo", "3", T0), (3, 8, 11, "Bo", "9", T0)],
        "reviews_id long, products_id long, customers_id long, customers_name string, reviews_rating string, date_added timestamp_ntz",
    )
    desc = spark.createDataFrame([(1, "great"), (2, "ok"), (3, "??")], "reviews_id long, reviews_text string")
    tgt = {
        "rating": spark.createDataFrame([(1, "Rating", 1, 0), (2, "Other", 1, 0)],
                                        "rating_id long, rating_code string, entity_id int, position int"),
        "rating_option": spark.createDataFrame([(1, 1, "1", 1, 1)],
                                               "option_id long, rating_id long, code string, value int, position int"),
    }
    out = RV.reviews_job({"reviews": reviews, "reviews_description": desc}, tgt, CFG)
    ratings = {r["rating_code"]: r["rating_id"] for r in out["rating"].collect()}
    assert ratings == {"Other": 2, "Rating": 3}
    votes = {r["review_id"]: (r["option_id"], r["percent"]) for r in out["rating_option_vote"].collect()}
    assert votes == {1: (5, 100), 2: (3, 60)}  # rating 9 has no option; old options of "Rating" replaced
    assert out["review_store"].count() == 4


@pytest.fixture(scope="module")
def review_tables(spark):
    reviews = spark.createDataFrame(
        [(1, 1, 10, "Ann", "5", T0), (2, 2, 11, "Bo", "3", T0)],
        "reviews_id long, products_id long, customers_id long, customers_name string, reviews_rating string, date_added timestamp_ntz",
    )
    desc = spark.createDataFrame([(1, "great"), (2, "ok")], "reviews_id long, reviews_text string")
    tgt = {
        "rating": spark.createDataFrame([(1, "Other", 1, 0)], "rating_id long, rating_code string, entity_id int, position int"),
        "rating_option": spark.createDataFrame([(1, 1, "1", 1, 1)], "option_id long, rating_id long, code string, value int, position int"),
    }
    return {"reviews": reviews, "reviews_description": desc}, tgt


def test_migrate_writes_merges_and_reruns(spark, src, catalog, review_tables, scratch):
    import os

    legacy = os.path.join(scratch, "legacy")
    target = os.path.join(scratch, "target")
    for name, df in {**src, **catalog[0], **review_tables[0]}.items():
        df.write.parquet(os.path.join(legacy, f"{name}.parquet"))
    for name, df in {**catalog[1], **review_tables[1]}.items():
        df.write.parquet(os.path.join(target, f"{name}.parquet"))

    def snapshot(names):
        return {n: sorted(map(repr, (tuple(r) for r in read_table(spark, os.path.join(target, n)).collect()))) for n in names}

    written = migrate(spark, legacy, target, CFG)
    first = snapshot(written)
    assert len(first["sales_flat_order"]) == 5
    names = read_table(spark, os.path.join(target, "catalog_product_entity_varchar")).collect()
    assert ("Bulb A", 71, 501) in [(r["value"], r["attribute_id"], r["entity_id"]) for r in names]  # existing row kept
    ents = {r["sku"] for r in read_table(spark, os.path.join(target, "catalog_product_entity")).collect()}
    assert "old-FLAG" not in ents and "real" in ents and "M1" in ents  # flagged replaced, legacy products added
    assert {r["rating_code"] for r in read_table(spark, os.path.join(target, "rating")).collect()} == {"Other", "Rating"}
    assert len(first["migration_record"]) >= 4
    migrate(spark, legacy, target, CFG)
    again = snapshot(written)
    for n in written:
        assert again[n] == first[n], n


def test_all_eight_total_classes(spark, src):
    classes = ["ot_total", "ot_shipping", "ot_subtotal", "ot_discount_coupon", "ot_tax", "ot_refund", "ot_insurance", "ot_signature"]
    rows = [(1, c, D(str(i + 1)), f"T{i}") for i, c in enumerate(classes)]
    with_all = dict(src)
    with_all["orders_total"] = spark.createDataFrame(rows, "orders_id long, class string, value decimal(12,4), title string")
    st = {r["orders_id"]: r for r in O.orders_stage(with_all, CFG).collect()}[1]
    got = [st[c] for c in ("order_total", "order_shipping_cost", "order_subtotal", "order_discount", "order_tax",
                           "order_refund", "order_insurance", "order_signature")]
    assert got == [D(str(i)) for i in range(1, 9)]
    assert (st["order_shipping_carrier"], st["order_discount_detail"]) == ("T1", "T3")
    core = {r["entity_id"]: r for r in O.orders_job(with_all, CFG)["sales_flat_order"].collect()}[1]
    assert core["shipping_amount"] == D("2") + D("7") + D("8")  # shipping + insurance + signature


def test_reconciliation_null_name_matches_nothing(spark, catalog):
    src, tgt = catalog
    desc = src["products_description"].union(
        spark.createDataFrame([(7, None, "d", "s", None, "c", "t")], src["products_description"].schema)
    )
    products = src["products"].union(
        spark.createDataFrame([(7, "M7", D("1"), "img/x/y.jpg", D("1"), None, None)], src["products"].schema)
    )
    names = tgt["catalog_product_entity_varchar"].union(
        spark.createDataFrame([(None, 71, 501, 4, 0)], tgt["catalog_product_entity_varchar"].schema)
    )
    rec = reconciliation_job({"products": products, "products_description": desc},
                             {**tgt, "catalog_product_entity_varchar": names}, CFG, legacy_set_id=10, shape="pairs")["migration_record"]
    row7 = [r for r in rec.collect() if r["legacy_id"] == 7]
    assert len(row7) == 1 and row7[0]["target_id"] is None
