"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import re

import pytest

import __spark_entry__ as E
from shopshift.checks import registry
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderkey", "status", "c_name", "item_count", "total_a", "total_n", "total_r"]
    assert df.count() > 0


def scans(df):
    """(table, columns read) of every scan of a test table in the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"FileScan parquet .*?Location: [^\[]*\[([^\]]*)\].*?ReadSchema: struct<([^\n]*)>", text)
    return [(os.path.basename(where).removesuffix(".parquet"), re.findall(r"(?:^|,)(\w+):", cols)) for where, cols in found if "testdata" in where]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_prunes(spark, name):
    """No Python UDF anywhere (the work stays in the JVM), and no scan of a wide table reads all its columns."""
    df = QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "ArrowEval" not in text
    for table, columns in scans(df):
        every = spark.read.parquet(f"{SF}/{table}.parquet").columns
        assert len(columns) < len(every) or len(every) <= 6, (table, columns)


READS = {
    "class_pivot": {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_extendedprice", "l_returnflag"]},
    "class_pivot_min": {"lineitem": ["l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag"]},
    "eav_varchar": {"part": ["p_partkey", "p_name", "p_brand", "p_type"]},
    "eav_int": {"part": ["p_partkey", "p_size"]},
    "eav_decimal": {"part": ["p_partkey", "p_retailprice"]},
    "path_parent": {"pages": ["page_id", "url"]},
    "rating_percent": {"events": ["event_id"]},
    "serialized_option": {"part": ["p_partkey", "p_name"]},
    "migration_record_grouped": {"part": ["p_partkey", "p_name"]},
}


@pytest.mark.parametrize("name", sorted(READS))
def test_scans_read_only_what_is_needed(spark, name):
    for table, columns in scans(QUERIES[name](spark, SF)):
        assert set(columns) <= set(READS[name][table]), (table, columns)


def test_order_core_reads_the_stage_once(spark):
    text = QUERIES["order_core"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet .*order_shipping_carrier|FileScan parquet .*customers_email", text)) == 1
    assert "transaction_type" in text and "IsNotNull(transaction_amount" in text  # paid totals straight from the history


def test_bridge_is_not_shuffled_by_category(spark):
    text = QUERIES["product_bridge"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(target_category" not in text and "hashpartitioning(product_type" not in text
    assert "BroadcastHashJoin" in text
