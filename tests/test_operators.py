"""Operators on hand-made frames: pivot duplicates, unpivot NULLs and scans, keys, updates, lookups."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopshift.operators.eav import resolve_attribute_ids, wide_to_eav
from shopshift.operators.keys import assign_keys, last_key, next_key
from shopshift.operators.lookups import map_codes, unmapped_report
from shopshift.operators.reshape import class_pivot, role_rows
from shopshift.operators.update import pick_first, update_from
from shopshift.sinks.writers import replace_where
from shopshift.sources.tables import inline_lookup

CLASSES = {"ot_total": {"total": "value"}, "ot_shipping": {"ship": "value", "carrier": "title"}}


def plan_text(df):
    """The executed plan (final adaptive plan only, without the initial one)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_class_pivot_one_row_per_key(spark):
    rows = [(1, "ot_total", 10.0, "T"), (1, "ot_shipping", 2.0, "UPS"), (2, "ot_total", 5.0, "T"), (3, "ot_tax", 1.0, "x")]
    df = spark.createDataFrame(rows, "orders_id long, class string, value double, title string")
    got = {r["orders_id"]: tuple(r)[1:] for r in class_pivot(df, "orders_id", "class", CLASSES).collect()}
    assert got == {1: (10.0, 2.0, "UPS"), 2: (5.0, None, None)}


def test_class_pivot_duplicates(spark):
    rows = [(1, "ot_total", 10.0, "a"), (1, "ot_total", 7.0, "b")]
    df = spark.createDataFrame(rows, "orders_id long, class string, value double, title string")
    with pytest.raises(Exception, match="several rows of class"):
        class_pivot(df, "orders_id", "class", CLASSES).collect()
    assert class_pivot(df, "orders_id", "class", CLASSES, on_duplicate="min").head()["total"] == 7.0


def test_class_pivot_scans_once(spark, scratch):
    path = f"{scratch}/totals"
    spark.createDataFrame([(i % 50, c, float(i), "t") for i in range(300) for c in ("ot_total", "ot_shipping")],
                          "orders_id long, class string, value double, title string").write.parquet(path)
    df = class_pivot(spark.read.parquet(path), "orders_id", "class", CLASSES, on_duplicate="min")
    df.collect()
    assert plan_text(df).count("Scan parquet") == 1


def test_wide_to_eav_keeps_nulls_and_counts(spark, scratch):
    path = f"{scratch}/wide"
    spark.createDataFrame([(1, "a", None), (2, None, "y"), (3, "c", "z")], "id long, f string, l string").write.parquet(path)
    wide = spark.read.parquet(path)
    eav = wide_to_eav(wide, "id", {5: "f", 7: "l"}, "string", {"entity_type_id": 1})
    rows = [tuple(r) for r in eav.collect()]
    assert len(rows) == 3 * 2
    assert (None, 7, 1, 1) in rows and (None, 5, 2, 1) in rows
    assert eav.columns == ["value", "attribute_id", "entity_id", "entity_type_id"]
    assert "Scan parquet" in plan_text(eav) and plan_text(eav).count("Scan parquet") == 1


def test_wide_to_eav_where(spark):
    df = spark.createDataFrame([(1, 78), (2, 79), (3, None)], "id long, z int")
    got = wide_to_eav(df, "id", {29: "z"}, "int", where={29: F.col("z") <= 78}).collect()
    assert [tuple(r) for r in got] == [(78, 29, 1)]


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_assign_keys_dense_unique_ordered(spark, parts):
    rows = [(i, f"n{(i * 7) % 13}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, name string").repartition(5)
    keyed = assign_keys(df, ["name", "id"], start=1000, num_partitions=parts)
    got = {r["id"]: r["entity_id"] for r in keyed.collect()}
    w = Window.orderBy("name", "id")
    want = {r["id"]: r["k"] for r in df.select("id", (F.row_number().over(w) + 999).alias("k")).collect()}
    assert got == want
    assert sorted(got.values()) == list(range(1000, 1200))
    again = {r["id"]: r["entity_id"] for r in assign_keys(df, ["name", "id"], start=1000, num_partitions=parts).collect()}
    assert again == got


def test_last_and_next_key(spark):
    df = spark.createDataFrame([(3,), (9,)], "k long")
    assert last_key(df, "k") == 9 and next_key(df, "k") == 10
    assert next_key(df.limit(0), "k") == 1


def test_replace_where_keeps_null_condition_rows(spark):
    t = spark.createDataFrame([(1, "a-FLAG"), (2, None), (3, "b")], "id long, sku string")
    new = spark.createDataFrame([(4, "c-FLAG")], "id long, sku string")
    got = sorted(r["id"] for r in replace_where(t, new, F.col("sku").endswith("FLAG")).collect())
    assert got == [2, 3, 4]


def test_update_from_condition_and_order(spark):
    hist = spark.createDataFrame(
        [(1, 10, "x; $5.00)", None, None), (2, 10, "note", None, None), (3, 11, None, None, None)],
        "hid long, oid long, comments string, transaction_id string, transaction_type string",
    )
    src = spark.createDataFrame([(10, "PP10"), (11, "PP11")], "oid long, txn string")
    u1 = update_from(
        hist, src, ["oid"], F.col("comments").rlike(r"\$[0-9]"),
        {"transaction_id": F.col("txn"), "transaction_type": F.lit("CHARGE")},
    )
    u2 = update_from(u1, src, ["oid"], F.col("transaction_id").isNull(), {"transaction_type": F.lit("FILL")})
    got = {r["hid"]: (r["transaction_id"], r["transaction_type"]) for r in u2.collect()}
    assert got == {1: ("PP10", "CHARGE"), 2: (None, "FILL"), 3: (None, "FILL")}
    assert u2.columns == hist.columns


def test_pick_first_tie_rule(spark):
    pays = spark.createDataFrame(
        [(1, Decimal("5.00"), "2020-01-02", 7), (1, Decimal("9.00"), "2020-01-01", 9), (1, Decimal("3.00"), "2020-01-01", 8)],
        "oid long, amount decimal(12,2), d string, hid long",
    )
    got = pick_first(pays, "oid", ["amount"], ["d", "hid"]).collect()
    assert [tuple(r) for r in got] == [(1, Decimal("3.00"))]


def test_map_codes_drop_and_report(spark):
    df = spark.createDataFrame([(1, "Visa"), (2, "visa "), (3, None), (4, "")], "id long, cc string")
    lk = inline_lookup(spark, "legacy string, cat_names string", [("", ""), ("Visa", "VI")])
    assert sorted(r["id"] for r in map_codes(df, lk, "cc", "legacy").collect()) == [1, 4]
    assert sorted(r["id"] for r in map_codes(df, lk, "cc", "legacy", fold=True).collect()) == [1, 2, 4]
    assert sorted(r["id"] for r in unmapped_report(df, lk, "cc", "legacy").collect()) == [2, 3]
    assert "BroadcastHashJoin" in plan_text(map_codes(df, lk, "cc", "legacy"))


def test_role_rows(spark):
    df = spark.createDataFrame([(1, "D", "B")], "id long, dn string, bn string")
    got = role_rows(df, {"shipping": {"lastname": "dn"}, "billing": {"lastname": "bn"}}, keep={"parent_id": "id"})
    assert sorted(tuple(r) for r in got.collect()) == [(1, "B", "billing"), (1, "D", "shipping")]
    with pytest.raises(ValueError):
        role_rows(df, {"a": {"x": "dn"}, "b": {"y": "bn"}})


def test_resolve_attribute_ids(spark):
    attrs = spark.createDataFrame([(71, "name"), (75, "price"), (80, "dup"), (81, "dup")], "attribute_id int, attribute_code string")
    assert resolve_attribute_ids(attrs, ["name", "price", "missing"]) == {"name": 71, "price": 75}
    with pytest.raises(ValueError):
        resolve_attribute_ids(attrs, ["dup"])
