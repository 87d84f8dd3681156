"""Checks of what changes between runs: descriptions, lasting ids, snapshot differences, increments."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.checks import standins as S
from shopshift.checks.catalog_checks import EXISTING_IDS, PARENT_SQL, PRODUCTS_SQL, TYPE_FRAMES_SQL, product_src
from shopshift.checks.registry import CHECK_CLASSES, register
from shopshift.checks.standins import Tables, with_ctes
from shopshift.operators.aggregate import group_count
from shopshift.operators.diff import snapshot_diff
from shopshift.operators.increment import merge_counts, merge_pivot, pivot_state
from shopshift.plans import products as PR
from shopshift.plans.reset import reset_job
from shopshift.session import ensure_checkpoint_dir
from shopshift.sinks.writers import refresh
from shopshift.sources.tables import read_table, version_log

# --- several descriptions of a product -----------------------------------------

#: Language ids of a product's description rows, by their number; the third repeats a language, the fourth has none.
_LANGUAGES = (1, 2, 2, None)
_PREFIXES = ("", "Zwei ", "Alt ", "Ohne ")


def several_descriptions(t: Tables) -> dict[str, DataFrame]:
    """Products with one to four description rows."""
    src = product_src(t)
    d = src["products_description"].withColumn("__row", F.explode(F.sequence(F.lit(0), (F.col("products_id") % 4).cast("int"))))
    language = F.coalesce(*[F.when(F.col("__row") == i, F.lit(x)) for i, x in enumerate(_LANGUAGES)])
    prefix = F.coalesce(*[F.when(F.col("__row") == i, F.lit(x)) for i, x in enumerate(_PREFIXES)])
    named = d.withColumn("language_id", language).withColumn("products_name", F.concat(prefix, F.col("products_name")))
    about = F.concat(F.col("products_description"), F.lit(" #"), F.col("__row").cast("string"))
    src["products_description"] = named.withColumn("products_description", about).drop("__row")
    return src


DESCRIPTIONS_SQL = """described as (
  select products_id, [1, 2, 2, null][i + 1] as language_id, ['', 'Zwei ', 'Alt ', 'Ohne '][i + 1] || products_name as products_name,
         products_description || ' #' || cast(i as varchar) as products_description
  from (select *, unnest(range(products_id % 4 + 1)) as i from products_description)),
in_two as (
  select * from (
    select *, count(*) over (partition by products_id) - 1 as unused,
           row_number() over (partition by products_id order by language_id is distinct from 2, language_id nulls last, products_name) as nth
    from described) where nth = 1),
per_language as (
  select * from (
    select *, coalesce(language_id, -1) as variant, count(*) over (partition by products_id, language_id) - 1 as unused,
           row_number() over (partition by products_id, language_id order by products_name) as nth
    from described) where nth = 1)"""


def catalogue_after(t: Tables, mode: str) -> dict[str, DataFrame]:
    """The catalogue job on products with several descriptions."""
    from shopshift.checks.legacy_db import target_tables, type_map_config

    cfg = replace(type_map_config(t), description_mode=mode, description_language=2)
    return PR.catalog_job(several_descriptions(t), target_tables(t), cfg, materialise_stages=True)


def entities_and_texts(job: dict[str, DataFrame]) -> DataFrame:
    """New entities with the name and the description that their value rows say."""
    new = job["catalog_product_entity"].filter(F.col("type_id") == "simple").select("entity_id", "sku")
    # 'name' and 'description' are codes of the stand-in dictionary
    names = job["catalog_product_entity_varchar"].select("entity_id", F.col("value").alias("name"))
    texts = job["catalog_product_entity_text"].filter(F.col("value").startswith("About ")).select("entity_id", F.col("value").alias("description"))
    return new.join(names, "entity_id").join(texts, "entity_id").select("entity_id", "sku", "name", "description")


def _entities_sql(rows: str, key: str) -> str:
    return with_ctes(
        PRODUCTS_SQL,
        DESCRIPTIONS_SQL,
        TYPE_FRAMES_SQL,
        f"""typed as (
  select p.products_id, d.*, concat_ws('-', tmap.legacy_type, d.products_name, 'FLAG') as sku
  from products p join {rows} d on p.products_id = d.products_id
  join tmap on tmap.legacy_type = {PARENT_SQL.format(s='p.products_image')}
  where p.products_model is not null and p.products_model <> '')""",
        body=f"""select {EXISTING_IDS} + (select max(p_partkey) from part where p_partkey % 4 <> 0)
       + row_number() over (order by sku, {key}) as entity_id, sku, products_name as name, products_description as description
from typed""",
    )


@register("catalog_one_description", _entities_sql("in_two", "products_id"))
def q_catalog_one_description(spark, d):
    """Entities of products with several descriptions: SKU, name and text of one row, that of the wanted language first."""
    return entities_and_texts(catalogue_after(Tables(spark, d), "one"))


@register("catalog_each_description", _entities_sql("per_language", "products_id, variant"))
def q_catalog_each_description(spark, d):
    """An entity for each language in which a product is described."""
    return entities_and_texts(catalogue_after(Tables(spark, d), "each"))


@register(
    "unused_descriptions",
    with_ctes(
        PRODUCTS_SQL,
        DESCRIPTIONS_SQL,
        body="""select 'one' as mode, products_id, 0 as variant, unused from in_two where unused > 0
union all select 'each', products_id, variant, unused from per_language where unused > 0""",
    ),
)
def q_unused_descriptions(spark, d):
    """How many description rows of which product the catalogue does not take, in both modes."""
    from shopshift.config import MigrationConfig

    src = several_descriptions(Tables(spark, d))
    frames = [
        PR.unused_descriptions(src, MigrationConfig(description_mode=mode, description_language=2)).withColumn("mode", F.lit(mode))
        for mode in ("one", "each")
    ]
    return frames[0].unionByName(frames[1]).select("mode", "products_id", "variant", "unused")


# --- ids that survive a changed catalogue -----------------------------------------


@register(
    "catalog_ids_kept",
    with_ctes(
        PRODUCTS_SQL,
        TYPE_FRAMES_SQL,
        f"""typed as (
  select p.products_id, concat_ws('-', tmap.legacy_type, d.products_name, 'FLAG') as sku
  from products p join products_description d on p.products_id = d.products_id
  join tmap on tmap.legacy_type = {PARENT_SQL.format(s='p.products_image')}
  where p.products_model is not null and p.products_model <> ''),
first_run as (
  select products_id, 50000000 - 1 + row_number() over (order by sku, products_id) as entity_id from typed where products_id % 6 <> 1),
second_run as (
  select products_id, (select max(entity_id) from first_run) + row_number() over (order by sku, products_id) as entity_id
  from typed where products_id % 6 = 1 and products_id % 11 <> 2)""",
        body="""select products_id, 0 as variant, entity_id, products_id % 11 <> 2 as live from first_run
union all select products_id, 0, entity_id, true from second_run""",
    ),
)
def q_catalog_ids_kept(spark, d):
    """Two runs, the second with products added and others gone: every id of the first stays, no id is given twice."""
    from shopshift.checks.legacy_db import target_tables, type_map_config

    t = Tables(spark, d)
    cfg = replace(type_map_config(t), first_catalog_id=50_000_000)
    src, tgt = product_src(t), target_tables(t)
    before = {**src, "products": src["products"].filter(F.col("products_id") % 6 != 1)}
    after = {**src, "products": src["products"].filter(F.col("products_id") % 11 != 2)}
    tgt["catalog_product_id_map"] = PR.catalog_job(before, tgt, cfg, materialise_stages=True)["catalog_product_id_map"]
    job = PR.catalog_job(after, tgt, cfg, materialise_stages=True)
    live = job["catalog_product_entity"].filter(F.col("type_id") == "simple").select("entity_id", F.lit(True).alias("live"))
    ids = job["catalog_product_id_map"].join(live, "entity_id", "left")
    return ids.select("products_id", "variant", "entity_id", F.coalesce("live", F.lit(False)).alias("live"))


# --- snapshot difference -----------------------------------------------------------

_SHIFT = 100_000_000


def later_orders(orders: DataFrame) -> DataFrame:
    """The next snapshot of the orders: some gone, some with another total or no status, some new."""
    k = F.col("o_orderkey")
    changed = orders.filter(k % 17 != 0).select(
        "o_orderkey",
        F.when(k % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return changed.unionByName(orders.filter(k % 23 == 0).withColumn("o_orderkey", k + _SHIFT))


@register(
    "snapshot_diff",
    f"""with old_ as (select o_orderkey, o_totalprice, o_orderstatus from orders),
new_ as (
  select o_orderkey, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
         case when o_orderkey % 7 = 0 then null else o_orderstatus end as o_orderstatus
  from old_ where o_orderkey % 17 <> 0
  union all select o_orderkey + {_SHIFT}, o_totalprice, o_orderstatus from old_ where o_orderkey % 23 = 0)
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey,
       case when o.o_orderkey is null then 'inserted' when n.o_orderkey is null then 'deleted'
            when o.o_totalprice is distinct from n.o_totalprice or o.o_orderstatus is distinct from n.o_orderstatus then 'changed'
            else 'unchanged' end as change,
       cast(o.o_orderkey is not null as bigint) as rows_old, cast(n.o_orderkey is not null as bigint) as rows_new
from old_ o full join new_ n on o.o_orderkey = n.o_orderkey""",
)
def q_snapshot_diff(spark, d):
    """Orders inserted, changed, deleted and unchanged between two snapshots, in one shuffle."""
    old = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return snapshot_diff(old, later_orders(old), ["o_orderkey"])


# --- increments ---------------------------------------------------------------------


def later_totals(totals: DataFrame) -> DataFrame:
    """The next snapshot of class-keyed totals: rows gone, changed, moved to another class, and new orders."""
    k = F.col("orders_id")
    kept = totals.filter(~((k % 5 == 0) & (F.col("class") == "A")) & (k % 19 != 0))
    changed = kept.withColumn("value", F.when(k % 3 == 0, F.lit(None).cast("decimal(18,2)")).when(k % 4 == 0, F.col("value") + 1).otherwise(F.col("value")).cast("decimal(18,2)"))
    return changed.unionByName(totals.filter(k % 29 == 0).withColumn("orders_id", k + _SHIFT))


LATER_TOTALS_SQL = f"""later as (
  select orders_id, class, cast(case when orders_id % 3 = 0 then null when orders_id % 4 = 0 then value + 1 else value end as decimal(18,2)) as value
  from v_totals where not (orders_id % 5 = 0 and class = 'A') and orders_id % 19 <> 0
  union all select orders_id + {_SHIFT}, class, value from v_totals where orders_id % 29 = 0)"""


@register(
    "pivot_after_change",
    with_ctes(
        S.V_TOTALS,
        LATER_TOTALS_SQL,
        body="""select orders_id, min(case when class = 'A' then value end) as total_a, min(case when class = 'N' then value end) as total_n,
       min(case when class = 'R' then value end) as total_r, count(*) as class_rows
from later where class in ('A', 'N', 'R') group by orders_id""",
    ),
)
def q_pivot_after_change(spark, d):
    """The class pivot of the first snapshot, brought to the second by their difference alone."""
    old = S.v_totals(Tables(spark, d))
    diff = snapshot_diff(old, later_totals(old), ["orders_id", "class"], carry=["value"])
    return merge_pivot(pivot_state(old, "orders_id", "class", CHECK_CLASSES), diff, "orders_id", "class", CHECK_CLASSES)


@register(
    "counts_after_change",
    f"""with later as (
  select l_orderkey from lineitem where l_linenumber <> 2 and l_orderkey % 13 <> 0
  union all select l_orderkey + {_SHIFT} from lineitem where l_orderkey % 31 = 0)
select l_orderkey, count(*) as product_count from later group by l_orderkey""",
)
def q_counts_after_change(spark, d):
    """Line counts per order of the first snapshot, brought to the second by their difference alone."""
    k = F.col("l_orderkey")
    old = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    new = old.filter((F.col("l_linenumber") != 2) & (k % 13 != 0)).unionByName(old.filter(k % 31 == 0).withColumn("l_orderkey", k + _SHIFT))
    diff = snapshot_diff(old, new, ["l_orderkey", "l_linenumber"])
    return merge_counts(group_count(old, "l_orderkey"), diff, "l_orderkey")


# --- tables written and read back ------------------------------------------------------


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/checks/{uuid.uuid4().hex}"


@register(
    "refresh_read_back",
    f"""select o_orderkey, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       case when o_orderkey % 7 = 0 then null else o_orderstatus end as o_orderstatus, 2 as version
from orders where o_orderkey % 17 <> 0
union all select o_orderkey + {_SHIFT}, o_totalprice, o_orderstatus, 2 from orders where o_orderkey % 23 = 0""",
)
def q_refresh_read_back(spark, d):
    """K3: the orders written as a table, replaced by their next snapshot, and read back with the version's number."""
    old = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = f"{_scratch(spark)}/orders"
    refresh(old, path)
    refresh(later_orders(read_table(spark, path)), path)
    return read_table(spark, path).withColumn("version", F.lit(version_log(spark, path)[-1]["version"]))


@register(
    "reset_read_back",
    """select 'customer_entity' as name, 0 as n_rows, 'entity_id,email' as columns
union all select 'customer_entity_varchar', 0, 'value,entity_id'
union all select 'customer_entity_int', count(*), 'value,entity_id' from customer""",
)
def q_reset_read_back(spark, d):
    """Customer tables written, two of them reset, all read back."""
    c = Tables(spark, d).customer
    base = _scratch(spark)
    refresh(c.select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("email")), f"{base}/customer_entity")
    refresh(c.select(F.col("c_name").alias("value"), F.col("c_custkey").alias("entity_id")), f"{base}/customer_entity_varchar")
    refresh(c.select(F.col("c_nationkey").alias("value"), F.col("c_custkey").alias("entity_id")), f"{base}/customer_entity_int")
    reset_job(spark, base)
    found = [(n, read_table(spark, f"{base}/{n}")) for n in ("customer_entity", "customer_entity_varchar", "customer_entity_int")]
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "n_rows", F.lit(",".join(t.columns)).alias("columns")) for n, t in found]
    return reduce(DataFrame.unionAll, counts)
