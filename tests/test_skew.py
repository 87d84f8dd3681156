"""Hot keys: one key holds a third of all rows; results stay whole and exact, no pairs are built."""

from pyspark.sql import functions as F

from shopshift.operators.aggregate import group_count
from shopshift.operators.joins import reconcile_grouped
from shopshift.operators.reshape import class_pivot
from shopshift.operators.update import pick_first

N = 30_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot_frame(spark, n=N):
    # key 0 holds a third of the rows; the rest spread over many keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id"),
        (F.col("id") % 97).cast("decimal(12,2)").alias("v"),
    )


def test_group_count_hot_key_is_partial(spark):
    out = group_count(hot_frame(spark), "k", "n")
    rows = {r["k"]: r["n"] for r in out.collect()}
    assert rows[0] == N // 3 and sum(rows.values()) == N
    p = plan(out)
    assert "partial_count" in p and p.index("partial_count") > p.index("Exchange")  # partial below the shuffle


def test_class_pivot_hot_key_min(spark):
    df = hot_frame(spark).select(
        "k", F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("c"), "v"
    )
    out = class_pivot(df, "k", "c", {"a": {"va": "v"}, "b": {"vb": "v"}}, on_duplicate="min")
    got = {r["k"]: (r["va"], r["vb"]) for r in out.collect()}
    assert got[0][0] == 0 and len(got) == df.select("k").distinct().count()
    assert "partial_min" in plan(out)


def test_pick_first_hot_key(spark):
    df = hot_frame(spark)
    got = {r["k"]: r["v"] for r in pick_first(df, "k", ["v"], ["id"]).collect()}
    assert got[0] == 0 and len(got) == df.select("k").distinct().count()


def test_grouped_reconciliation_is_linear(spark):
    left = hot_frame(spark).select(F.col("id").alias("lid"), F.col("k").cast("string").alias("name"))
    right = hot_frame(spark).select(F.col("id").alias("rid"), F.col("k").cast("string").alias("rname"))
    rows, matches = reconcile_grouped(left, right, "name", "rname")
    assert rows.count() == N and matches.count() == N  # the pair form would hold (N/3)^2 + ... rows
    hot = rows.filter(F.col("name") == "0").select("match_count").distinct().collect()
    assert [r[0] for r in hot] == [N // 3]


def test_hot_sku_bridge_is_many_to_one(spark):
    # every product of the hot group links to the single entity of its SKU
    from shopshift.operators.joins import computed_key_join

    products = hot_frame(spark).select("id", F.col("k").cast("string").alias("t"))
    entities = products.select(F.concat(F.col("t"), F.lit("-FLAG")).alias("sku")).distinct().withColumn(
        "entity_id", F.monotonically_increasing_id()
    )
    out = computed_key_join(products, F.concat(F.col("t"), F.lit("-FLAG")), entities, "sku", "inner")
    assert out.count() == N


def test_hot_order_partition_is_split(spark):
    """An order with a third of all history rows: both sides of the join are shuffled, so AQE splits its partition."""
    from shopshift.sources.tables import materialise

    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    history = materialise(hot_frame(spark, 200_000).select("k", "id", F.sha2(F.col("id").cast("string"), 256).alias("comment")))
    orders = materialise(history.select("k").distinct().withColumn("total", F.lit(1)))
    for key, value in zip(keep, ("-1", "100k", "100k", "1.5"), strict=True):
        spark.conf.set(key, value)
    try:
        out = orders.join(history, "k")
        assert out.agg(F.count("comment")).first()[0] == 200_000
        out = orders.join(history, "k").select("comment")
        out.collect()
        assert "skew" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)
