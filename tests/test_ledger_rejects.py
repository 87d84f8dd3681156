"""Ledgers, rejects, key constraints, store views and salted joins."""

import pytest
from pyspark.sql import functions as F

from shopshift.operators.constraints import key_violations
from shopshift.operators.eav import eav_with_fallback
from shopshift.operators.ledger import Ledger
from shopshift.operators.rejects import split_rejects, too_long
from shopshift.operators.salted import heavy_keys, salted_join
from shopshift.plans.validate import violations
from shopshift.sources.tables import Stages, materialise, stages_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


# --- ledger -----------------------------------------------------------------------


def test_counts_equal_anti_joins(spark):
    left = materialise(spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"), "id"))
    right = materialise(spark.range(60).select((F.col("id") % 40).alias("k"), F.col("id").alias("r")))
    for how in ("inner", "left"):
        ledger = Ledger()
        out = materialise(ledger.join("step", left, right, "k", how), ledger=ledger)
        want = left.join(right, "k", how)
        assert out.columns == want.columns and rows(out) == rows(want)
        e = ledger.entries[0]
        missed = left.join(right, "k", "left_anti").count()
        assert (e.rows_in, e.rows_out, e.dropped) == (1000, want.count(), missed)
        assert e.multiplied == left.join(right, "k", "inner").count() - (1000 - missed)
        assert rows(ledger.frame(spark)) == [("step", e.rows_in, e.rows_out, e.dropped, e.multiplied)]
    # the plan reads each side once
    p = plan(Ledger().join("step", left, right, "k"))
    assert p.count("FileScan") == 2 and p.count("CollectMetrics") == 2
    with pytest.raises(ValueError):
        Ledger().join("step", left, right, "k", "full")


def test_nothing_and_everything_dropped(spark):
    left, none = spark.range(5).withColumnRenamed("id", "k"), spark.createDataFrame([], "k long")
    ledger = Ledger()
    for name, a, b in (("none", left, none), ("all", left, left), ("empty", none, left)):
        materialise(ledger.join(name, a, b, "k"), ledger=ledger)
    assert [(e.rows_in, e.rows_out, e.dropped, e.multiplied) for e in ledger.entries] == [(5, 0, 5, 0), (5, 5, 0, 0), (0, 0, 0, 0)]


def test_a_resumed_stage_keeps_its_counts(spark, scratch):
    from shopshift.plans.journal import Journal

    left, right = spark.range(9).withColumnRenamed("id", "k"), spark.range(4).withColumnRenamed("id", "k")
    found = []
    for _ in range(2):
        journal, ledger = Journal(spark, scratch, "run-1"), Ledger()
        with stages_of(Stages(spark, "run-1", journal)):
            out = materialise(ledger.join("step", left, right, "k"), "named", ledger)
        assert out.count() == 4
        found.append(ledger.entries)
        left = left.limit(0)  # what is planned now is not run
    assert found[0] == found[1] and found[0][0].dropped == 5


# --- rejects --------------------------------------------------------------------------


def test_every_row_is_on_one_side(spark):
    data = [(1, "a", "ok"), (1, "a", "again"), (2, "a", "much too long"), (2, "b", None), (None, "c", "x"), (None, "c", "y"), (3, "d", "fine")]
    df = spark.createDataFrame(data, "k long, class string, title string").withColumn("__n", F.lit(1))
    good, bad = split_rejects(df, {"long": too_long("title", 6), "none": F.col("title").isNull()}, {"repeated": ["k", "class"]})
    assert good.columns == df.columns
    assert rows(good, "k", "title") == [(3, "fine")]
    got = {(r["k"], r["title"]): r["reasons"] for r in bad.collect()}
    assert got == {(1, "ok"): ["repeated"], (1, "again"): ["repeated"], (2, "much too long"): ["long"], (2, None): ["none"],
                   (None, "x"): ["repeated"], (None, "y"): ["repeated"]}
    both = split_rejects(df.limit(0), {"long": too_long("title", 6)})
    assert [b.count() for b in both] == [0, 0]


def test_the_source_is_read_once(spark):
    source = materialise(spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("title")))
    good, bad = split_rejects(source, {"long": too_long("title", 3)}, {"repeated": ["k"]})
    path = source.inputFiles()[0].rsplit("/", 1)[0]
    for out in (good, bad):
        assert not any(f.startswith(path) for f in out.inputFiles())  # the stage, not the source
    assert good.count() + bad.count() == 10_000
    assert bad.filter(F.array_contains("reasons", "repeated")).count() == 3334


# --- key constraints -------------------------------------------------------------------


def test_planted_violations_are_found_in_one_shuffle(spark):
    def t(data, schema):
        return materialise(spark.createDataFrame(data, schema))

    tables = {
        "parent": t([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "id long, code string"),
        "child": t([(10, 1, "a"), (11, 2, "b"), (12, 2, "x"), (13, 2, "x"), (14, None, "a")], "id long, parent_id int, parent_code string"),
        "alone": t([(1,), (1,), (1,)], "id long"),
    }
    out = key_violations(tables, {"parent": ["id", "code"], "child": ["id"], "alone": ["id"]}, [("child", ["parent_id", "parent_code"], "parent"), ("gone", ["x"], "parent")])
    assert rows(out, "kind", "name", "key", "n_rows") == [
        ("orphan", "child", "2,x", 2), ("repeated", "alone", "1", 3), ("repeated", "parent", "1,a", 2), ("repeated", "parent", "NULL,c", 2)]
    p = plan(out)
    assert p.count("Exchange") == 1 and "partial_count_if" in p.lower() or p.count("Exchange") == 1 and "partial_count" in p
    with pytest.raises(ValueError):
        key_violations(tables, {"child": ["id"]}, [("child", ["parent_id"], "parent")])


def test_declared_keys_of_the_target_model(spark):
    orders = spark.createDataFrame([(1,), (2,), (2,)], "entity_id long")
    items = spark.createDataFrame([(1,), (7,)], "order_id long")
    got = rows(violations({"sales_flat_order": orders, "sales_flat_order_item": items}), "kind", "name", "key", "n_rows")
    assert got == [("orphan", "sales_flat_order_item", "7", 1), ("repeated", "sales_flat_order", "2", 2)]


# --- store views -------------------------------------------------------------------------


def test_own_value_before_the_default(spark):
    data = [(1, 71, 0, "d1"), (1, 71, 1, "o1"), (2, 71, 0, "d2"), (2, 71, 1, None), (3, 71, 1, "o3"), (4, 71, 2, "other"), (5, 72, 0, "b"), (5, 72, 0, "a"), (6, 99, 1, "z")]
    values = materialise(spark.createDataFrame(data, "entity_id long, attribute_id int, store_id int, value string"))
    out = eav_with_fallback(values, {"name": 71, "brand": 72}, 1)
    assert rows(out) == sorted([(1, "o1", None), (2, "d2", None), (3, "o3", None), (5, None, "a")], key=str)
    assert rows(eav_with_fallback(values, {"name": 71}, 0)) == [(1, "d1"), (2, "d2")]
    p = plan(out)
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and "PushedFilters" in p or p.count("FileScan") == 1
    with pytest.raises(ValueError):
        eav_with_fallback(values, {}, 1)


# --- salted joins --------------------------------------------------------------------------


def test_a_key_with_a_third_of_both_sides(spark):
    left = materialise(spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("l")))
    right = materialise(spark.range(90).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("r")))
    assert heavy_keys(left, "k") == [0]
    for how in ("inner", "left"):
        out = salted_join(left, right, "k", how, salts=8)
        want = left.join(right, "k", how)
        assert out.columns == want.columns and rows(out) == rows(want)
    hot = left.filter("k = 0").select(F.pmod(F.xxhash64("k", "l"), F.lit(8)).alias("s")).groupBy("s").count().collect()
    assert len(hot) == 8 and max(r["count"] for r in hot) < 2 * 1000 / 8
    # no heavy key: a plain join
    even = spark.range(1000).select(F.col("id").alias("k"))
    assert heavy_keys(even, "k") == [] and "__salt" not in plan(salted_join(even, even, "k"))
    assert salted_join(left.limit(0), right, "k").count() == 0
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full")
