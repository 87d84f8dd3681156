"""Row choice, lasting ids, snapshot differences and the increments that follow from them."""

import random

import pytest
from pyspark.sql import functions as F

from shopshift.config import MigrationConfig
from shopshift.operators.aggregate import group_count
from shopshift.operators.choose import choose_row
from shopshift.operators.diff import changes_only, snapshot_diff
from shopshift.operators.idmap import KeyConflict, extend_id_map, refuse_conflicts, with_ids
from shopshift.operators.increment import merge_counts, merge_pivot, pivot_state
from shopshift.plans import products as PR
from shopshift.sources.tables import materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


# --- one row of a group -----------------------------------------------------------


def test_choose_row_takes_whole_rows(spark):
    data = [(1, 2, "b", None), (1, 2, "a", "x"), (1, 1, "z", "y"), (2, None, "n", "m"), (None, 3, "o", "p"), (None, 3, "o", "p")]
    df = spark.createDataFrame(data, "k long, lang int, name string, text string")
    order = [~F.col("lang").eqNullSafe(F.lit(2)), F.col("lang").isNull()]
    want = [(1, 2, "a", "x", 2), (2, None, "n", "m", 0), (None, 3, "o", "p", 1)]
    for n in (1, 4):
        assert rows(choose_row(df.repartition(n), ["k"], order, "unused")) == sorted(want, key=str)
    assert rows(choose_row(df, ["k"]), "k", "lang", "name") == sorted([(1, 1, "z"), (2, None, "n"), (None, 3, "o")], key=str)
    assert choose_row(df.limit(0), ["k"], order, "unused").count() == 0


def test_choose_row_hot_key_is_partial(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("name"))
    out = choose_row(df, ["k"], [F.col("name")], "unused")
    assert out.agg(F.sum("unused")).first()[0] == 20_000 - out.count()
    p = plan(out)
    assert p.count("Exchange") == 1 and "partial_min" in p


def described(spark):
    products = spark.createDataFrame([(1, "M1"), (2, "M2"), (3, None)], "products_id long, products_model string").withColumn(
        "products_price", F.lit(1).cast("decimal(12,4)")
    )
    products = products.select("*", *[F.lit("kits/a.jpg").alias(c) for c in ("products_image", "products_image_med", "products_image_pop")], F.lit(1).alias("products_weight"))
    d = spark.createDataFrame(
        [(1, 1, "One"), (1, 2, "Uno"), (1, 2, "Eins"), (2, None, "None"), (2, 5, "Fem"), (3, 1, "Three")],
        "products_id long, language_id int, products_name string",
    )
    for c in PR.DESCRIBED[1:]:
        d = d.withColumn(c, F.concat(F.lit(f"{c} "), "products_name"))
    return {"products": products, "products_description": d}


def test_descriptions_are_of_one_row(spark):
    src = described(spark)
    name = ["products_id", "variant", "products_name", "products_tech_specs"]
    for cfg, want in (
        (MigrationConfig(), {(1, 0): "One", (2, 0): "Fem"}),
        (MigrationConfig(description_language=2), {(1, 0): "Eins", (2, 0): "Fem"}),
        (MigrationConfig(description_mode="each"), {(1, 1): "One", (1, 2): "Eins", (2, -1): "None", (2, 5): "Fem"}),
    ):
        got = {(p, v): (n, t) for p, v, n, t in rows(PR.catalog_products(src, cfg), *name)}
        assert got == {k: (n, f"products_tech_specs {n}") for k, n in want.items()}
        unused = {(p, v): u for p, v, u in rows(PR.unused_descriptions(src, cfg))}
        assert unused == ({(1, 2): 1} if cfg.description_mode == "each" else {(1, 0): 2, (2, 0): 1})
    assert rows(PR.legacy_products(src, MigrationConfig(description_language=2)), "products_id", "products_name") == [(1, "Eins"), (2, "Fem"), (3, "Three")]
    with pytest.raises(ValueError):
        PR.catalog_products(src, MigrationConfig(description_mode="both"))
    # a table without languages
    src["products_description"] = src["products_description"].drop("language_id")
    assert [r[1] for r in rows(PR.catalog_products(src), "products_id", "products_name")] == ["Eins", "Fem"]


# --- lasting ids --------------------------------------------------------------------


def test_ids_last(spark):
    def keys(*names):
        return spark.createDataFrame([(n,) for n in names], "name string")

    first = materialise(extend_id_map(None, keys("c", "a", None), ["name"], ["name"], 10))
    assert rows(first) == sorted([(None, 10), ("a", 11), ("c", 12)], key=str)
    second = materialise(extend_id_map(first, keys("b", "a", "d", None), ["name"], [F.desc("name")]))
    # c is gone and keeps its id; the new ones come after all ids ever given
    assert rows(second) == sorted([(None, 10), ("a", 11), ("c", 12), ("d", 13), ("b", 14)], key=str)
    assert rows(extend_id_map(second, keys("c"), ["name"], ["name"], 99)) == rows(second)
    assert rows(extend_id_map(second, keys("e"), ["name"], ["name"], 99))[-2:] == sorted([("e", 99), (None, 10)], key=str)
    assert rows(with_ids(keys("b", "x", "a"), second, ["name"])) == [("a", 11), ("b", 14)]
    refuse_conflicts(first, second.filter("entity_id > 12"), "new")
    with pytest.raises(KeyConflict, match="3 new ids from 10 to 12"):
        refuse_conflicts(first, second, "new")


# --- snapshot differences --------------------------------------------------------------


def test_differences(spark):
    schema = "k long, a string, b string"
    old = spark.createDataFrame([(1, "x", "y"), (2, "a", None), (3, "g", "g"), (None, "n", "n"), (5, "p", "q"), (5, "r", "s"), (6, "p", "p"), (6, "q", "q")], schema)
    new = spark.createDataFrame([(1, "x", "y"), (2, None, "a"), (4, "i", "i"), (None, "n", "m"), (5, "r", "s"), (5, "p", "q"), (6, "p", "p"), (6, "p", "p")], schema)
    out = snapshot_diff(old, new, ["k"], carry=["b", "a"])
    want = [
        (1, "unchanged", 1, 1, ("y", "x")), (2, "changed", 1, 1, ("a", None)), (3, "deleted", 1, 0, None), (4, "inserted", 0, 1, ("i", "i")),
        (None, "changed", 1, 1, ("m", "n")), (5, "unchanged", 2, 2, ("q", "p")), (6, "changed", 2, 2, ("p", "p")),
    ]
    assert [(*r[:4], r[4] and tuple(r[4])) for r in rows(out)] == sorted(want, key=str)
    assert {r[0] for r in rows(changes_only(out))} == {2, 3, 4, 6, None}
    # a column that is not compared
    assert {r[0] for r in rows(changes_only(snapshot_diff(old, new, ["k"], ["a"])))} == {2, 3, 4, 6}
    assert {r[1] for r in rows(snapshot_diff(old, old, ["k"]))} == {"unchanged"}
    assert snapshot_diff(old.limit(0), new.limit(0), ["k"]).count() == 0
    p = plan(snapshot_diff(materialise(old), materialise(new), ["k"]))
    assert p.count("Exchange") == 1 and p.count("FileScan") == 2 and "partial_sum" in p
    with pytest.raises(TypeError):
        snapshot_diff(old, new.withColumn("a", F.lit(1)), ["k"])


# --- increments ---------------------------------------------------------------------------

CLASSES = {"t": {"total": "value"}, "s": {"ship": "value", "carrier": "title"}}


def random_totals(rng, n):
    keys = [None, *range(n)]
    out = {(k, c) for k in keys for c in "tsx" if rng.random() < 0.6}
    return [(k, c, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for k, c in out]


def test_a_state_follows_the_snapshots(spark):
    rng, schema = random.Random(8), "k long, class string, value long, title string"
    old = spark.createDataFrame(random_totals(rng, 40), schema)
    state, counts = pivot_state(old, "k", "class", CLASSES), group_count(old, "k")
    for _ in range(2):
        new = spark.createDataFrame(random_totals(rng, 50), schema)
        diff = materialise(snapshot_diff(old, new, ["k", "class"], carry=["value", "title"]))
        state, counts = materialise(merge_pivot(state, diff, "k", "class", CLASSES)), materialise(merge_counts(counts, diff, "k"))
        full = pivot_state(new, "k", "class", CLASSES)
        assert state.columns == full.columns and rows(state) == rows(full)
        assert rows(counts) == rows(group_count(new, "k"))
        old = new


def test_a_second_row_of_a_class(spark):
    schema = "k long, class string, value long, title string"
    old, new = spark.createDataFrame([(1, "s", 5, "u")], schema), spark.createDataFrame([(1, "s", 3, "z"), (1, "s", 3, "b"), (2, "x", 1, "q")], schema)
    diff = snapshot_diff(old, new, ["k", "class"], carry=["value", "title"])
    with pytest.raises(Exception, match="several rows of class s"):
        merge_pivot(pivot_state(old, "k", "class", CLASSES), diff, "k", "class", CLASSES).collect()
    least = merge_pivot(pivot_state(old, "k", "class", CLASSES, "min"), diff, "k", "class", CLASSES, "min")
    assert rows(least) == rows(pivot_state(new, "k", "class", CLASSES, "min")) == [(1, None, 3, "b", 2)]
    with pytest.raises(ValueError):
        merge_pivot(least, snapshot_diff(old, new, ["k", "class"], carry=["title", "value"]), "k", "class", CLASSES, "min")


def test_number_columns_are_hash_aggregated(spark):
    totals = materialise(spark.createDataFrame([(1, "t", 1)], "k long, class string, value long"))
    p = plan(pivot_state(totals, "k", "class", {"t": {"total": "value"}}))
    assert "HashAggregate" in p and "SortAggregate" not in p
