"""Legacy-shaped stand-ins derived from the shared test tables, as DataFrames and as SQL.

Each stand-in exists twice: a DataFrame built with the library's operators
(what the checks run on Spark) and an SQL text (what the DuckDB oracle runs).
Both read whole tables; none caps or samples rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift.sources.tables import load_table


class Tables:
    """Lazy access to the test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load_table(self.spark, self.sf_dir, name)


# --- customers -------------------------------------------------------------

def v_customers(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    return c.select(
        k.alias("customers_id"),
        F.when(k % 3 == 0, F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))).otherwise(F.col("c_name")).alias("full_name"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("firstname"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("lastname"),
        F.when(k % 2 == 0, F.lit("")).when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("suburb"),
        F.col("c_nationkey").alias("zone_id"),
    )


V_CUSTOMERS = """v_customers as (
  select c_custkey as customers_id,
         case when c_custkey % 3 = 0 then replace(c_name, '#', ' ') else c_name end as full_name,
         case when c_custkey % 5 = 0 then null else c_name end as firstname,
         case when c_custkey % 7 = 0 then null else c_mktsegment end as lastname,
         case when c_custkey % 2 = 0 then '' when c_custkey % 3 = 0 then null else c_mktsegment end as suburb,
         c_nationkey as zone_id
  from customer)"""


# --- class-keyed order totals ----------------------------------------------

def v_totals(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.groupBy(F.col("l_orderkey").alias("orders_id"), F.col("l_returnflag").alias("class")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value")
    )


V_TOTALS = """v_totals as (
  select l_orderkey as orders_id, l_returnflag as class,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as value
  from lineitem group by l_orderkey, l_returnflag)"""


# --- status history with amounts in comments ---------------------------------

def v_history(t: Tables) -> DataFrame:
    e = t.events
    amt = F.when(F.col("event_id") % 7 == 0, -F.col("value")).otherwise(F.col("value")).cast("decimal(12,2)")
    comment = F.when(
        F.col("event_type").isin("purchase", "error"),
        F.concat(F.lit("pay ("), F.col("event_type"), F.lit("; $"), amt.cast("string"), F.lit(")")),
    ).otherwise(F.concat(F.lit("note "), F.col("event_type")))
    return e.select(
        F.col("event_id").alias("history_id"),
        F.floor(F.col("event_id") / 2).cast("long").alias("orders_id"),
        F.col("event_type").alias("status_code"),
        F.col("ts").alias("date_added"),
        comment.alias("comments"),
    )


V_HISTORY = """v_history as (
  select event_id as history_id, cast(floor(event_id / 2) as bigint) as orders_id,
         event_type as status_code, ts as date_added,
         case when event_type in ('purchase', 'error')
              then 'pay (' || event_type || '; $' ||
                   cast(cast(case when event_id % 7 = 0 then -value else value end as decimal(12,2)) as varchar) || ')'
              else 'note ' || event_type end as comments
  from events)"""


def history_stage(t: Tables) -> DataFrame:
    """A staged payment history: v_history joined to its order, transaction columns empty."""
    h = v_history(t)
    o = t.orders
    j = h.join(o, h["orders_id"] == o["o_orderkey"], "inner")
    null_s = F.lit(None).cast("string")
    return j.select(
        "orders_id",
        F.col("history_id").alias("orders_status_history_id"),
        F.when(F.col("status_code") == "signup", F.lit("pending"))
        .when(F.col("status_code") == "purchase", F.lit("complete"))
        .otherwise(F.col("status_code"))
        .alias("status"),
        F.when(F.col("history_id") % 3 == 0, F.col("date_added")).otherwise(F.col("o_orderdate")).alias("order_date_purchased"),
        "date_added",
        "comments",
        null_s.alias("transaction_id"),
        null_s.alias("transaction_type"),
        F.lit(None).cast("decimal(12,2)").alias("transaction_amount"),
        null_s.alias("transaction_avs"),
        null_s.alias("transaction_cvv2"),
        null_s.alias("transaction_msgs"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("PP"), F.col("o_orderkey").cast("string")))
        .alias("o_paypal_txn_id"),
        F.col("o_orderpriority").alias("o_cc_avs_response"),
        F.col("o_orderstatus").alias("o_cc_cvv2_response"),
    )


HISTORY_STAGE = V_HISTORY + """,
history_stage as (
  select h.orders_id, h.history_id as orders_status_history_id,
         case when h.status_code = 'signup' then 'pending'
              when h.status_code = 'purchase' then 'complete' else h.status_code end as status,
         case when h.history_id % 3 = 0 then h.date_added else o.o_orderdate end as order_date_purchased,
         h.date_added, h.comments,
         cast(null as varchar) as transaction_id, cast(null as varchar) as transaction_type,
         cast(null as decimal(12,2)) as transaction_amount, cast(null as varchar) as transaction_avs,
         cast(null as varchar) as transaction_cvv2, cast(null as varchar) as transaction_msgs,
         case when o.o_orderkey % 4 = 0 then '' else 'PP' || cast(o.o_orderkey as varchar) end as o_paypal_txn_id,
         o.o_orderpriority as o_cc_avs_response, o.o_orderstatus as o_cc_cvv2_response
  from v_history h join orders o on h.orders_id = o.o_orderkey)"""


def order_totals_stage(t: Tables) -> DataFrame:
    """Orders of the mapped statuses with their total, as the payment repair reads them."""
    o = t.orders
    return o.filter(F.col("o_orderstatus").isin("O", "F")).select(
        F.col("o_orderkey").alias("orders_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("order_total"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("order_shipping_cost"),
        F.lit(None).cast("decimal(12,2)").alias("order_insurance"),
        F.lit(None).cast("decimal(12,2)").alias("order_signature"),
    )


ORDER_TOTALS_STAGE = """order_totals_stage as (
  select o_orderkey as orders_id, cast(o_totalprice as decimal(12,2)) as order_total
  from orders where o_orderstatus in ('O', 'F'))"""


# --- attribute dictionary derived from product types -------------------------

def ranked_types(t: Tables) -> DataFrame:
    """Distinct product types with their rank in type order (1, 2, ...), as two-pass keys (no global window)."""
    from shopshift.operators.keys import assign_keys

    return assign_keys(t.part.select("p_type").distinct(), ["p_type"], start=1, key_col="type_rank")


def v_attributes(t: Tables) -> DataFrame:
    """One attribute per product type: id 500 + rank of the type, code the lower-case type, entity type 4."""
    return ranked_types(t).select(
        (F.lit(500) + F.col("type_rank")).cast("int").alias("attribute_id"),
        F.lower(F.col("p_type")).alias("attribute_code"),
        F.lit(4).alias("entity_type_id"),
    )


V_ATTRIBUTES = """v_attributes as (
  select cast(500 + dense_rank() over (order by p_type) as integer) as attribute_id,
         lower(p_type) as attribute_code, 4 as entity_type_id
  from (select distinct p_type from part) d)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body
