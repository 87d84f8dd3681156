"""Checks of what a run says about its data: ledgers, rejects, key violations, store views, hot joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.checks import standins as S
from shopshift.checks.registry import CHECK_STATUS_MAP, STATUS_VALUES_SQL, register
from shopshift.checks.standins import Tables, with_ctes
from shopshift.functions import columns as X
from shopshift.operators.constraints import key_violations
from shopshift.operators.eav import eav_with_fallback
from shopshift.operators.ledger import Ledger
from shopshift.operators.lookups import map_codes
from shopshift.operators.rejects import REASONS, split_rejects, too_long
from shopshift.operators.salted import salted_join
from shopshift.sources.tables import inline_lookup, materialise


@register(
    "join_ledger",
    f"""with mapped as (
  select o.o_orderkey, o.o_custkey from orders o join {STATUS_VALUES_SQL} m on o.o_orderstatus = m.code),
few as (select * from lineitem where l_orderkey % 7 <> 0),
lines as (select m.*, f.l_linenumber from mapped m join few f on m.o_orderkey = f.l_orderkey),
chosen as (select c_custkey from customer where c_custkey % 5 <> 0 union all select c_custkey from customer where c_custkey % 10 = 1)
select 'status' as step, (select count(*) from orders) as rows_in, (select count(*) from mapped) as rows_out,
       (select count(*) from orders where o_orderstatus is null or o_orderstatus not in (select code from {STATUS_VALUES_SQL} m)) as dropped, 0 as multiplied
union all
select 'lines', (select count(*) from mapped), (select count(*) from lines),
       (select count(*) from mapped where o_orderkey not in (select l_orderkey from few)),
       (select sum(n - 1) from (select count(*) as n from lines group by o_orderkey) g)
union all
select 'customer', (select count(*) from lines), (select count(*) from lines left join chosen on o_custkey = c_custkey),
       (select count(*) from lines where not exists (select 1 from chosen where c_custkey = o_custkey)),
       (select count(*) from lines left join chosen on o_custkey = c_custkey) - (select count(*) from lines)""",
)
def q_join_ledger(spark, d):
    """Rows kept, dropped and multiplied by three joins, counted while their result is written once."""
    t, ledger = Tables(spark, d), Ledger()
    lookup = inline_lookup(spark, "code string, status string", CHECK_STATUS_MAP)
    mapped = map_codes(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), lookup, "o_orderstatus", "code", ledger=ledger, step="status")
    few = t.lineitem.filter(F.col("l_orderkey") % 7 != 0).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    lines = ledger.join("lines", mapped, few, "o_orderkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    some = c.filter(F.col("o_custkey") % 5 != 0).unionByName(c.filter(F.col("o_custkey") % 10 == 1))
    materialise(ledger.join("customer", lines, some, "o_custkey", "left"), ledger=ledger)
    return ledger.frame(spark)


def _split(good: DataFrame, rejects: DataFrame, *cols: str) -> DataFrame:
    said = F.array_join(REASONS, ",").alias(REASONS)
    return good.select(*cols, F.lit("").alias(REASONS)).unionByName(rejects.select(*cols, said))


@register(
    "totals_rejects",
    with_ctes(
        S.V_TOTALS,
        """marked as (
  select orders_id, class, value, 'T' || repeat('x', cast(orders_id % 9 as integer)) as title from v_totals
  union all select orders_id, class, value + 1, null from v_totals where orders_id % 11 = 0 and class = 'A')""",
        body="""select orders_id, class, value,
       concat_ws(',', case when value is null then 'no value' end, case when length(title) > 8 then 'long title' end,
                 case when count(*) over (partition by orders_id, class) > 1 then 'repeated class' end) as reasons
from marked""",
    ),
)
def q_totals_rejects(spark, d):
    """Class-keyed totals split into good rows and rejects: titles that are too long, classes that an order has twice."""
    totals = S.v_totals(Tables(spark, d))
    titled = totals.withColumn("title", F.concat(F.lit("T"), F.repeat(F.lit("x"), (F.col("orders_id") % 9).cast("int"))))
    again = totals.filter((F.col("orders_id") % 11 == 0) & (F.col("class") == "A"))
    again = again.select("orders_id", "class", (F.col("value") + 1).cast("decimal(18,2)").alias("value"), F.lit(None).cast("string").alias("title"))
    rules = {"no value": F.col("value").isNull(), "long title": too_long("title", 8)}
    return _split(*split_rejects(titled.unionByName(again), rules, {"repeated class": ["orders_id", "class"]}), "orders_id", "class", "value")


@register(
    "amount_rejects",
    with_ctes(
        S.V_HISTORY,
        body="""select history_id, case when status_code in ('purchase', 'error') and history_id % 9 = 0 then 'amount' else '' end as reasons
from v_history""",
    ),
)
def q_amount_rejects(spark, d):
    """History rows whose comment carries an amount that cannot be read."""
    h = S.v_history(Tables(spark, d))
    broken = F.concat(F.lit("(a) x"), F.substring_index("comments", ";", -1))
    broken = F.replace(broken, F.lit(" $"), F.lit("; $"))
    pays = F.col("status_code").isin("purchase", "error")
    h = h.withColumn("comments", F.when(pays & (F.col("history_id") % 9 == 0), broken).otherwise(F.col("comments")))
    amount = X.comment_amount("comments", "decimal(12,2)")[1]
    return _split(*split_rejects(h, {"amount": X.carries_amount("comments") & amount.isNull()}), "history_id")


@register(
    "key_violations",
    """with own as (select o_orderkey, o_custkey from orders where o_orderkey % 41 <> 0
             union all select o_orderkey, null from orders where o_orderkey % 50 = 0),
known as (select c_custkey from customer where c_custkey % 37 <> 0)
select 'repeated' as kind, 'orders' as name, cast(o_orderkey as varchar) as key, count(*) as n_rows from own group by o_orderkey having count(*) > 1
union all
select 'orphan', 'lineitem', cast(l_orderkey as varchar), count(*) from lineitem where l_orderkey not in (select o_orderkey from own) group by l_orderkey
union all
select 'orphan', 'orders', cast(o_custkey as varchar), count(*) from own
where o_custkey is not null and o_custkey not in (select c_custkey from known) group by o_custkey""",
)
def q_key_violations(spark, d):
    """Repeated keys and orphans of three tables, found in one shuffle."""
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", "o_custkey")
    own = o.filter(F.col("o_orderkey") % 41 != 0).unionByName(o.filter(F.col("o_orderkey") % 50 == 0).withColumn("o_custkey", F.lit(None).cast("long")))
    tables = {"orders": own, "lineitem": t.lineitem, "customer": t.customer.filter(F.col("c_custkey") % 37 != 0)}
    return key_violations(
        tables,
        {"orders": ["o_orderkey"], "customer": ["c_custkey"]},
        [("lineitem", ["l_orderkey"], "orders"), ("orders", ["o_custkey"], "customer")],
    )


@register(
    "store_view",
    """select p_partkey as entity_id,
       case when p_partkey % 3 = 0 and p_partkey % 9 <> 0 then 'Shop ' || p_name else p_name end as name,
       case when p_partkey % 5 = 0 then p_brand end as brand
from part""",
)
def q_store_view(spark, d):
    """Attribute values as store 1 sees them: its own, else those of store 0; another store's do not count."""
    part = Tables(spark, d).part
    k = F.col("p_partkey")

    def rows(df: DataFrame, attribute: int, store: int, value) -> DataFrame:
        return df.select(k.alias("entity_id"), F.lit(attribute).alias("attribute_id"), F.lit(store).alias("store_id"), value.alias("value"))

    shop = F.when(k % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("Shop "), F.col("p_name")))
    values = rows(part, 71, 0, F.col("p_name")).unionByName(rows(part.filter(k % 3 == 0), 71, 1, shop))
    values = values.unionByName(rows(part.filter(k % 5 == 0), 72, 1, F.col("p_brand"))).unionByName(rows(part, 72, 2, F.col("p_type")))
    return eav_with_fallback(values, {"name": 71, "brand": 72}, store_id=1)


@register(
    "hot_key_join",
    """select event_id, n_nationkey from (select event_id, case when event_id % 3 = 0 then 0 else event_id % 1000 end as k from events) e
left join (select n_nationkey, case when n_nationkey % 3 = 0 then 0 else n_nationkey end as k from nation) n on e.k = n.k""",
)
def q_hot_key_join(spark, d):
    """A left join whose key 0 holds a third of both sides."""
    t = Tables(spark, d)
    left = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("event_id") % 1000).alias("k"))
    right = t.nation.select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, 0).otherwise(F.col("n_nationkey")).alias("k"))
    return salted_join(left, right, "k", "left").select("event_id", "n_nationkey")
