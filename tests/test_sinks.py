"""Sinks: conforming to a declared schema, snapshot refresh, reset, record table."""

import pytest
from pyspark.sql import types as T

from shopshift.plans.reconcile import MIGRATION_RECORD
from shopshift.plans.reset import reset_job
from shopshift.sinks.writers import append_union, check_schema, conform, drop_old_versions, record_table, refresh
from shopshift.sources.tables import live_folders, load_table, read_table

SCHEMA = T.StructType([T.StructField("entity_id", T.LongType()), T.StructField("email", T.StringType()),
                       T.StructField("store_id", T.IntegerType())])


def test_conform_fills_missing_and_casts(spark):
    df = spark.createDataFrame([("7", "a@b")], "id string, mail string")
    out = conform(df, SCHEMA, {"entity_id": "id", "email": "mail"})
    assert out.schema == SCHEMA
    assert tuple(out.head()) == (7, "a@b", None)
    with pytest.raises(ValueError):
        conform(df, SCHEMA, {"nope": "id"})


def test_append_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "order_id long, name string")
    b = spark.createDataFrame([(2, 5)], "order_id long, parent_item_id long")
    got = sorted(tuple(r) for r in append_union([a, b]).collect())
    assert got == [(1, "x", None), (2, None, 5)]


def test_refresh_is_rerunnable(spark, scratch):
    path = f"{scratch}/customer_entity"
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    first = refresh(df, path)
    second = refresh(df, path)
    assert first != second
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == sorted(tuple(r) for r in df.collect())


def test_reset_job_keeps_schema(spark, scratch):
    for name in ("customer_entity", "customer_entity_varchar"):
        refresh(spark.createDataFrame([(1, "a", 1)], SCHEMA), f"{scratch}/{name}")
    reset_job(spark, scratch)
    for name in ("customer_entity", "customer_entity_varchar"):
        df = read_table(spark, f"{scratch}/{name}")
        assert df.count() == 0 and df.schema == SCHEMA


def test_record_table_declared_schema(spark, scratch):
    rows = spark.createDataFrame([(1, "m", "n", None, None, None)],
                                 "legacy_id int, legacy_sku string, legacy_name string, target_id int, target_sku string, target_name string")
    out = record_table(rows, MIGRATION_RECORD, f"{scratch}/migration_record")
    assert out.schema == MIGRATION_RECORD
    assert read_table(spark, f"{scratch}/migration_record").count() == 1


def test_reset_and_refresh_of_a_parquet_input(spark, scratch):
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.parquet(f"{scratch}/customer_entity.parquet")
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.parquet(f"{scratch}/customer_entity_varchar")
    assert load_table(spark, scratch, "customer_entity").count() == 1
    reset_job(spark, scratch)
    assert load_table(spark, scratch, "customer_entity").count() == 0
    assert load_table(spark, scratch, "customer_entity_varchar").count() == 0
    # a path with or without the suffix is the same table
    refresh(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA), f"{scratch}/customer_entity.parquet")
    assert load_table(spark, scratch, "customer_entity").count() == 2
    reset_job(spark, scratch)
    assert load_table(spark, scratch, "customer_entity").count() == 0


def test_damaged_version_log_is_an_error(spark, scratch):
    path = f"{scratch}/rating"
    refresh(spark.createDataFrame([(1, "a", 1)], SCHEMA), path)
    with open(f"{path}.versions/part-damaged.json", "w") as f:
        f.write('{"version": "x", "folders"')
    with pytest.raises(Exception):
        read_table(spark, path)
    refresh(spark.createDataFrame([(1, "a", 1)], SCHEMA), f"{scratch}/twice")
    with open(f"{scratch}/twice.versions/part-again.json", "w") as f:
        f.write('{"version": 1, "run_id": "r", "folders": ["/nowhere"]}\n')
    with pytest.raises(ValueError):
        read_table(spark, f"{scratch}/twice")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{scratch}/absent")
    assert live_folders(spark, f"{scratch}/absent") == []


def test_declared_schema_is_enforced(spark, scratch):
    path = f"{scratch}/t"
    ok = spark.createDataFrame([(1, "a")], "entity_id int, email string")
    refresh(ok, path, SCHEMA)
    assert tuple(read_table(spark, path).head()) == (1, "a", None)
    for wrong in ("entity_id string, email string", "entity_id long, email string, more int", "entity_id long, store_id long"):
        with pytest.raises(TypeError):
            check_schema(spark.createDataFrame([], wrong), SCHEMA, "t")


def test_old_versions_are_dropped(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(0, "z", 1)], SCHEMA).write.parquet(path)
    folders = [refresh(spark.createDataFrame([(i, "a", 1)], SCHEMA), path) for i in range(4)]
    assert drop_old_versions(spark, path, keep=2) == sorted(folders[:2])
    assert [r["entity_id"] for r in read_table(spark, path).collect()] == [3]
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(folders[2]).count() == 1
    with pytest.raises(ValueError):
        drop_old_versions(spark, path, keep=0)
