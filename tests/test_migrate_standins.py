"""The whole migration on legacy tables derived from the shared test tables, against the checked queries."""

import os
from decimal import Decimal

import pytest

import __spark_entry__ as E
from shopshift.checks.legacy_db import write_legacy_db
from shopshift.plans.run import KeyConflict, migrate
from shopshift.plans.validate import check_targets
from shopshift.sinks.writers import refresh
from shopshift.sources.tables import read_table, version_log

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def rows(df, cols=None):
    df = df.select(*cols) if cols else df
    # amounts compare by value: a target column may have more decimals
    return sorted(repr(tuple(float(v) if isinstance(v, Decimal) else v for v in r)) for r in df.collect())


def test_migrate_matches_checked_queries(spark, scratch):
    legacy, target = os.path.join(scratch, "legacy"), os.path.join(scratch, "target")
    cfg = write_legacy_db(spark, SF, legacy, target)
    written = migrate(spark, legacy, target, cfg)
    expected = {
        "sales_flat_order": "order_core",
        "sales_flat_order_grid": "order_grid",
        "sales_flat_order_address": "order_addresses",
        "sales_flat_order_status_history": "order_status_history",
        "sales_flat_order_payment": "order_payment_rows",
        "customer_address_entity_varchar": "address_varchar",
        "customer_entity_int": "default_address",
        "rating_option_vote": "rating_vote",
        "review_store": "review_store",
    }
    q = E.queries()
    for table, check in expected.items():
        want = q[check](spark, SF)
        got = read_table(spark, os.path.join(target, table))
        assert rows(got, want.columns) == rows(want), table
    flag = cfg.migrate_flag

    def entities():
        return {r["entity_id"]: r["sku"] for r in read_table(spark, os.path.join(target, "catalog_product_entity")).collect()}

    before = {r["entity_id"]: r["sku"] for r in spark.read.parquet(os.path.join(target, "catalog_product_entity.parquet")).collect()}
    stay = {i: k for i, k in before.items() if not k.endswith(flag)}
    described = spark.read.parquet(os.path.join(legacy, "products_description.parquet"))
    products = spark.read.parquet(os.path.join(legacy, "products.parquet")).join(described, "products_id", "left_semi")
    # the second description of a product is counted, not lost silently
    unused = read_table(spark, os.path.join(target, "catalog_product_description_unused"))
    assert unused.agg({"unused": "sum"}).first()[0] == described.count() - products.count() > 0
    now = entities()
    assert stay.items() <= now.items()  # nothing that stays is touched
    new = q["product_bridge"](spark, SF).select("products_id").distinct().count()
    assert len([k for k in now.values() if k and k.endswith(flag)]) == new  # one for each product
    assert len(now) == len(stay) + new + products.count()
    for table in ("varchar", "decimal", "int", "text"):
        values = read_table(spark, os.path.join(target, f"catalog_product_entity_{table}"))
        assert values.groupBy("entity_id", "attribute_id", "store_id").count().filter("count > 1").isEmpty(), table
        assert {r[0] for r in values.select("entity_id").distinct().collect()} <= set(now), table
    # the ledger of the run against anti joins
    ledger = {r["step"]: r for r in read_table(spark, os.path.join(target, "migration_ledger")).collect()}
    legacy_orders = spark.read.parquet(os.path.join(legacy, "orders.parquet"))
    kept = read_table(spark, os.path.join(target, "sales_flat_order")).count()
    status = ledger["orders: status"]
    assert (status["rows_in"], status["rows_out"], status["dropped"], status["multiplied"]) == (legacy_orders.count(), kept, legacy_orders.count() - kept, 0)
    without = spark.read.parquet(os.path.join(legacy, "products.parquet")).join(described, "products_id", "left_anti").count()
    assert ledger["legacy products: description"]["dropped"] == without > 0
    assert ledger["orders: totals"]["rows_out"] == kept
    # what the target model's keys say of the result: rows without their parent are of parents that the jobs do not write
    broken = {(r["kind"], r["name"]) for r in check_targets(spark, target).collect()}
    assert not {b for b in broken if b[0] == "repeated" and b[1].startswith(("sales", "customer", "catalog_product_entity"))}, broken
    # a second run leaves every table as it is
    first = {t: rows(read_table(spark, os.path.join(target, t))) for t in written}
    assert all(first[t] for t in written if t != "catalog_product_entity_text")
    again = migrate(spark, legacy, target, cfg)
    assert set(again) == set(written)
    for table in written:
        assert rows(read_table(spark, os.path.join(target, table))) == first[table], table
    logs = {version_log(spark, os.path.join(target, t))[-1]["run_id"] for t in written}
    assert len(logs) == 1  # published as one run


def test_migrate_refuses_ids_that_stay(spark, scratch):
    legacy, target = os.path.join(scratch, "legacy"), os.path.join(scratch, "target")
    cfg = write_legacy_db(spark, SF, legacy, target)
    clash = spark.createDataFrame([(2, "mine", 1)], "entity_id long, sku string, attribute_set_id int")
    refresh(clash, os.path.join(target, "catalog_product_entity"))
    with pytest.raises(KeyConflict):
        migrate(spark, legacy, target, cfg, jobs=("catalog", "legacy_products"))
    assert read_table(spark, os.path.join(target, "catalog_product_entity")).count() == 1
