"""Checks of the product side: unpivots, keys, snapshot replace, SKU bridge, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.checks import standins as S
from shopshift.checks.registry import register
from shopshift.checks.standins import Tables, with_ctes
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.eav import constant_attribute, resolve_attribute_ids, wide_to_eav
from shopshift.operators.keys import assign_keys, next_key
from shopshift.plans import products as PR
from shopshift.plans.reconcile import catalogue_names, reconciliation_job
from shopshift.sinks.writers import replace_where
from shopshift.sources.tables import materialise

CFG = C.MigrationConfig()


def product_src(t: Tables) -> dict[str, DataFrame]:
    p = t.part
    k = F.col("p_partkey")
    slug = F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
    products = p.select(
        k.alias("products_id"),
        F.when(k % 10 == 0, F.lit(None)).when(k % 10 == 1, F.lit("")).otherwise(F.concat(F.lit("M-"), k.cast("string"))).alias("products_model"),
        F.col("p_retailprice").cast("decimal(12,4)").alias("products_price"),
        F.col("p_size").cast("decimal(12,4)").alias("products_weight"),
        F.when(k % 9 == 0, F.concat(slug, F.lit(".jpg")))
        .otherwise(F.concat(F.lit("img/"), F.lower("p_type"), F.lit("/"), slug, F.lit(".jpg")))
        .alias("products_image"),
        F.lit(None).cast("string").alias("products_image_med"),
        F.lit(None).cast("string").alias("products_image_pop"),
    )
    desc = p.filter(k % 13 != 0).select(
        k.alias("products_id"),
        F.col("p_name").alias("products_name"),
        F.concat(F.lit("About "), F.col("p_name")).alias("products_description"),
        F.col("p_brand").alias("products_short_description"),
        F.lit(None).cast("string").alias("products_whats_included"),
        F.col("p_type").alias("products_compatibility"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("products_tech_specs"),
    )
    return {"products": products, "products_description": desc}


PRODUCTS_SQL = """products as (
  select p_partkey as products_id,
         case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then '' else 'M-' || cast(p_partkey as varchar) end as products_model,
         cast(p_retailprice as decimal(12,4)) as products_price,
         cast(p_size as decimal(12,4)) as products_weight,
         case when p_partkey % 9 = 0 then replace(p_name, ' ', '-') || '.jpg'
              else 'img/' || lower(p_type) || '/' || replace(p_name, ' ', '-') || '.jpg' end as products_image
  from part),
products_description as (
  select p_partkey as products_id, p_name as products_name, 'About ' || p_name as products_description,
         p_brand as products_short_description, p_type as products_compatibility,
         'size ' || cast(p_size as varchar) as products_tech_specs
  from part where p_partkey % 13 <> 0)"""

PARENT_SQL = "case when strpos({s}, '/') = 0 then {s} else split_part({s}, '/', -2) end"


@register(
    "products_described",
    with_ctes(
        PRODUCTS_SQL,
        body="""select p.products_id, p.products_model, d.products_name, p.products_price
from products p join products_description d on p.products_id = d.products_id""",
    ),
)
def q_products_described(spark, d):
    return PR.legacy_products(product_src(Tables(spark, d)))


@register("path_parent", f"select page_id, {PARENT_SQL.format(s='url')} as folder from pages")
def q_path_parent(spark, d):
    return Tables(spark, d).pages.select("page_id", X.path_parent("url").alias("folder"))


@register(
    "catalog_types",
    with_ctes(
        PRODUCTS_SQL,
        body=f"""select p.products_id, p.products_model, {PARENT_SQL.format(s='p.products_image')} as product_type
from products p join products_description d on p.products_id = d.products_id
where p.products_model is not null and p.products_model <> ''""",
    ),
)
def q_catalog_types(spark, d):
    st = PR.catalog_products(product_src(Tables(spark, d)))
    return st.select("products_id", "products_model", "product_type")


@register(
    "assign_keys",
    "select p_partkey, 999 + row_number() over (order by p_name, p_partkey) as entity_id from part",
)
def q_assign_keys(spark, d):
    part = Tables(spark, d).part.select("p_partkey", "p_name")
    return assign_keys(part, ["p_name", "p_partkey"], start=1000).select("p_partkey", "entity_id")


@register(
    "replace_flagged",
    """select entity_id, sku from (
  select p_partkey as entity_id, case when p_partkey % 3 = 0 then p_name || '-FLAG' else p_name end as sku from part) e
where not (sku like '%FLAG')
union all
select 100000 + p_partkey, concat_ws('-', p_type, p_name, 'FLAG') from part""",
)
def q_replace_flagged(spark, d):
    part = Tables(spark, d).part
    k = F.col("p_partkey")
    existing = part.select(
        k.alias("entity_id"),
        F.when(k % 3 == 0, F.concat(F.col("p_name"), F.lit("-FLAG"))).otherwise(F.col("p_name")).alias("sku"),
    )
    new = part.select(
        (F.lit(100000) + k).alias("entity_id"), X.legacy_sku("p_type", "p_name", "FLAG").alias("sku")
    )
    return replace_where(existing, new, P.ends_with("sku", "FLAG"))


def _type_frames(t: Tables):
    """Type map, attribute sets and category names derived from the product types."""
    types = S.ranked_types(t)
    tmap = types.filter(F.col("p_type") != "PROMO").select(
        F.lower("p_type").alias("legacy_type"),
        F.col("p_type").alias("target_set_name"),
        F.concat(F.lower("p_type"), F.lit("-cat")).alias("target_category"),
    )
    sets = types.select(
        (F.lit(10) + F.col("type_rank")).cast("int").alias("attribute_set_id"),
        F.col("p_type").alias("attribute_set_name"),
    )
    cats = types.select(
        (F.lit(200) + F.col("type_rank")).cast("long").alias("entity_id"),
        F.concat(F.lower("p_type"), F.lit("-cat")).alias("value"),
        F.lit(C.CATEGORY_NAME_ATTRIBUTE_ID).alias("attribute_id"),
    ).unionByName(
        types.select(
            (F.lit(300) + F.col("type_rank")).cast("long").alias("entity_id"),
            F.concat(F.lower("p_type"), F.lit("-cat")).alias("value"),
            F.lit(C.CATEGORY_NAME_ATTRIBUTE_ID + 1).alias("attribute_id"),
        )
    )
    return tmap, sets, cats


#: Existing catalogue entities have ids above those of all legacy products.
EXISTING_IDS = 10_000_000


def _existing_entities(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        (F.lit(EXISTING_IDS) + k).cast("long").alias("entity_id"),
        # some carry the flag of an earlier run
        F.concat(F.lit("C-"), k.cast("string"), F.when(k % 4 == 0, F.lit("-FLAG")).otherwise("")).alias("sku"),
        F.lit(1).alias("attribute_set_id"),
    )


TYPE_FRAMES_SQL = """types as (select distinct p_type from part),
tmap as (select lower(p_type) as legacy_type, p_type as target_set_name, lower(p_type) || '-cat' as target_category
         from types where p_type <> 'PROMO'),
sets as (select cast(10 + dense_rank() over (order by p_type) as integer) as attribute_set_id, p_type as attribute_set_name from types),
cats as (select 200 + dense_rank() over (order by p_type) as entity_id, lower(p_type) || '-cat' as value, 43 as attribute_id from types
         union all
         select 300 + dense_rank() over (order by p_type), lower(p_type) || '-cat', 44 from types)"""

ENTITIES_SQL = f"""ents as (
  select s.products_id, concat_ws('-', s.product_type, s.products_name, 'FLAG') as sku, st.attribute_set_id,
         {EXISTING_IDS} + (select max(p_partkey) from part where p_partkey % 4 <> 0)
           + row_number() over (order by concat_ws('-', s.product_type, s.products_name, 'FLAG'), s.products_id) as entity_id
  from staged s join tmap on s.product_type = tmap.legacy_type join sets st on tmap.target_set_name = st.attribute_set_name)"""

STAGED_SQL = f"""staged as (
  select p.products_id, d.products_name, {PARENT_SQL.format(s='p.products_image')} as product_type
  from products p join products_description d on p.products_id = d.products_id
  where p.products_model is not null and p.products_model <> '')"""


@register(
    "product_bridge",
    with_ctes(
        PRODUCTS_SQL,
        TYPE_FRAMES_SQL,
        STAGED_SQL,
        ENTITIES_SQL,
        body="""select s.products_id, e.entity_id, e.sku, c.entity_id as category_id
from staged s
join ents e on s.products_id = e.products_id
join tmap on s.product_type = tmap.legacy_type
join cats c on tmap.target_category = c.value and c.attribute_id = 43""",
    ),
)
def q_product_bridge(spark, d):
    """Catalogue entities created per product, written and read back, then bridged by product id."""
    return catalogue_bridge(Tables(spark, d)).select("products_id", "entity_id", "sku", "category_id")


def new_entities(t: Tables) -> DataFrame:
    """The check's new entities, after those that stay."""
    tmap, sets, _ = _type_frames(t)
    existing = _existing_entities(t)
    first = next_key(existing.filter(~P.ends_with("sku", CFG.migrate_flag)), "entity_id")
    return PR.new_catalog_entities(PR.catalog_products(product_src(t)), tmap, sets, CFG, first)


def catalogue_bridge(t: Tables) -> DataFrame:
    tmap, _, cats = _type_frames(t)
    return PR.product_bridge(PR.catalog_products(product_src(t)), materialise(new_entities(t)), tmap, cats, CFG)


@register(
    "catalog_product_entity",
    with_ctes(
        PRODUCTS_SQL,
        TYPE_FRAMES_SQL,
        STAGED_SQL,
        ENTITIES_SQL,
        body=f"""select {EXISTING_IDS} + p_partkey as entity_id, 'C-' || cast(p_partkey as varchar) as sku, 1 as attribute_set_id,
       cast(null as varchar) as type_id, cast(null as integer) as entity_type_id, cast(null as integer) as has_options,
       cast(null as integer) as required_options, cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
from part where p_partkey % 4 <> 0
union all
select entity_id, sku, attribute_set_id, 'simple', 4, 0, 0, timestamp '{CFG.run_timestamp}', timestamp '{CFG.run_timestamp}' from ents""",
    ),
)
def q_catalog_product_entity(spark, d):
    """The catalogue after the job: entities without the flag, and one new entity per product."""
    t = Tables(spark, d)
    return replace_where(_existing_entities(t), new_entities(t).drop(*PR.ENTITY_KEY), P.ends_with("sku", CFG.migrate_flag))


@register(
    "catalog_category_product",
    with_ctes(
        PRODUCTS_SQL,
        TYPE_FRAMES_SQL,
        STAGED_SQL,
        ENTITIES_SQL,
        body="""select e.entity_id as product_id, c.entity_id as category_id, 1 as position
from ents e join staged s on e.products_id = s.products_id
join tmap on s.product_type = tmap.legacy_type
join cats c on tmap.target_category = c.value and c.attribute_id = 43""",
    ),
)
def q_catalog_category_product(spark, d):
    return catalogue_bridge(Tables(spark, d)).select(
        F.col("entity_id").alias("product_id"), "category_id", F.lit(1).alias("position")
    )


@register(
    "stored_sku_bridge",
    with_ctes(
        PRODUCTS_SQL,
        STAGED_SQL,
        body="""select s.products_id, m.p_partkey as entity_id from staged s
join (select min(p_partkey) as p_partkey, p_name, p_type from part group by p_name, p_type) m
  on concat_ws('-', s.product_type, s.products_name, 'FLAG') = concat_ws('-', lower(p_type), p_name, 'FLAG')""",
    ),
)
def q_stored_sku_bridge(spark, d):
    """Entities of an earlier run found again by the SKU computed from type and name (one per SKU)."""
    t = Tables(spark, d)
    stored = t.part.groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("entity_id")).select(
        "entity_id", X.legacy_sku(F.lower("p_type"), "p_name", CFG.migrate_flag).alias("sku")
    )
    return PR.stored_bridge(PR.catalog_products(product_src(t)), stored, CFG).select("products_id", "entity_id")


def catalogue_tgt(t: Tables, one_per_name: bool = False) -> dict[str, DataFrame]:
    """Catalogue products named like the parts, a fifth of them in the legacy set; or one product per name."""
    p = t.part.select("p_partkey", "p_name")
    if one_per_name:
        p = p.groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey"))
    ent = F.lit(50000) + F.col("p_partkey")
    return {
        "catalog_product_entity_varchar": p.select(
            F.col("p_name").alias("value"), F.lit(71).alias("attribute_id"), ent.alias("entity_id")
        ),
        "catalog_product_entity": p.select(
            ent.alias("entity_id"),
            F.concat(F.lit("C-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.when(F.col("p_partkey") % 5 == 0, F.lit(2)).otherwise(F.lit(1)).alias("attribute_set_id"),
        ),
    }


CATALOGUE_SQL = """cat_names as (
  select p_name as name, 50000 + p_partkey as entity_id, 'C-' || cast(p_partkey as varchar) as sku
  from part where p_partkey % 5 <> 0)"""

UNIQUE_CATALOGUE_SQL = """cat_names as (
  select p_name as name, 50000 + k as entity_id, 'C-' || cast(k as varchar) as sku
  from (select p_name, min(p_partkey) as k from part group by p_name) u where k % 5 <> 0)"""


@register("eav_attribute_view", with_ctes(CATALOGUE_SQL, body="select name, entity_id, sku from cat_names"))
def q_eav_attribute_view(spark, d):
    return catalogue_names(catalogue_tgt(Tables(spark, d)), 2)


@register(
    "migration_record",
    with_ctes(
        PRODUCTS_SQL,
        UNIQUE_CATALOGUE_SQL,
        body="""select p.products_id as legacy_id, p.products_model as legacy_sku, d.products_name as legacy_name,
       cat_names.entity_id as target_id, cat_names.sku as target_sku, cat_names.name as target_name
from products p join products_description d on p.products_id = d.products_id
left join cat_names on d.products_name = cat_names.name
where p.products_model is not null and p.products_model != ''""",
    ),
)
def q_migration_record(spark, d):
    t = Tables(spark, d)
    tgt = catalogue_tgt(t, one_per_name=True)
    return reconciliation_job(product_src(t), tgt, CFG, legacy_set_id=2, shape="pairs")["migration_record"]


@register(
    "attr_by_code",
    with_ctes(
        S.V_ATTRIBUTES,
        body="select p_name as value, a.attribute_id, p_partkey as entity_id from part join v_attributes a on a.attribute_code = 'small'",
    ),
)
def q_attr_by_code(spark, d):
    t = Tables(spark, d)
    ids = resolve_attribute_ids(S.v_attributes(t), ["small"])
    # a code that the dictionary lacks gives no rows
    return wide_to_eav(t.part, "p_partkey", {ids.get("small", -1): "p_name"}, "string").filter(F.lit("small" in ids))


@register(
    "new_group_attributes",
    with_ctes(
        S.V_ATTRIBUTES,
        body="""select attribute_id, 7 as attribute_group_id, 9 as attribute_set_id, 4 as entity_type_id
from v_attributes where entity_type_id = 4 and attribute_code in ('economy', 'small', 'promo')""",
    ),
)
def q_new_group_attributes(spark, d):
    a = S.v_attributes(Tables(spark, d))
    return a.filter(P.equals("entity_type_id", 4) & P.one_of("attribute_code", ["economy", "small", "promo"])).select(
        "attribute_id",
        F.lit(7).alias("attribute_group_id"),
        F.lit(9).alias("attribute_set_id"),
        F.lit(4).alias("entity_type_id"),
    )


_EAV_CONSTS = {"entity_type_id": 4, "store_id": 0}


@register(
    "eav_varchar",
    """select p_name as value, 71 as attribute_id, p_partkey as entity_id, 4 as entity_type_id, 0 as store_id from part
union all select p_brand, 72, p_partkey, 4, 0 from part
union all select p_type, 73, p_partkey, 4, 0 from part""",
)
def q_eav_varchar(spark, d):
    part = Tables(spark, d).part
    return wide_to_eav(part, "p_partkey", {71: "p_name", 72: "p_brand", 73: "p_type"}, "string", _EAV_CONSTS)


@register(
    "eav_int",
    "select p_size as value, 74 as attribute_id, p_partkey as entity_id, 4 as entity_type_id, 0 as store_id from part",
)
def q_eav_int(spark, d):
    return wide_to_eav(Tables(spark, d).part, "p_partkey", {74: "p_size"}, "int", _EAV_CONSTS)


@register(
    "eav_decimal",
    """select cast(p_retailprice as decimal(12,4)) as value, 75 as attribute_id, p_partkey as entity_id,
       4 as entity_type_id, 0 as store_id from part""",
)
def q_eav_decimal(spark, d):
    return wide_to_eav(Tables(spark, d).part, "p_partkey", {75: "p_retailprice"}, "decimal(12,4)", _EAV_CONSTS)


@register(
    "eav_status",
    with_ctes(
        PRODUCTS_SQL,
        body="""select 1 as value, 96 as attribute_id, p.products_id as entity_id, 4 as entity_type_id, 0 as store_id
from products p join products_description d on p.products_id = d.products_id""",
    ),
)
def q_eav_status(spark, d):
    lp = PR.legacy_products(product_src(Tables(spark, d)))
    return constant_attribute(lp, "products_id", C.LEGACY_PRODUCT_ATTR["status"], 1, _EAV_CONSTS)


def legacy_tgt(t: Tables) -> dict[str, DataFrame]:
    _, sets, _ = _type_frames(t)
    n = t.nation
    return {
        "eav_attribute_set": sets.select("attribute_set_id", "attribute_set_name", F.lit(4).alias("entity_type_id")),
        "eav_attribute_group": n.select(
            F.col("n_nationkey").alias("attribute_group_id"),
            F.col("n_regionkey").alias("attribute_set_id"),
            F.col("n_name").alias("attribute_group_name"),
        ),
        "eav_attribute": S.v_attributes(t),
    }


@register(
    "legacy_product_entity",
    with_ctes(
        PRODUCTS_SQL,
        TYPE_FRAMES_SQL,
        body="""select p.products_id as entity_id, p.products_model as sku, 4 as entity_type_id,
       (select max(attribute_set_id) + 1 from sets) as attribute_set_id, 'simple' as type_id
from products p join products_description d on p.products_id = d.products_id""",
    ),
)
def q_legacy_product_entity(spark, d):
    t = Tables(spark, d)
    return PR.legacy_products_job(product_src(t), legacy_tgt(t), CFG)["catalog_product_entity"]


@register(
    "migration_record_grouped",
    with_ctes(
        PRODUCTS_SQL,
        CATALOGUE_SQL,
        body="""select p.products_id as legacy_id, p.products_model as legacy_sku, d.products_name as legacy_name,
       coalesce(m.match_count, 0) as match_count
from products p join products_description d on p.products_id = d.products_id
left join (select name, count(*) as match_count from cat_names group by name) m on d.products_name = m.name
where p.products_model is not null and p.products_model != ''""",
    ),
)
def q_migration_record_grouped(spark, d):
    """Reconciliation in the exact grouped shape: one row per legacy product with its match count."""
    t = Tables(spark, d)
    return reconciliation_job(product_src(t), catalogue_tgt(t), CFG, legacy_set_id=2)["migration_record"]


@register(
    "migration_record_matches",
    with_ctes(
        PRODUCTS_SQL,
        CATALOGUE_SQL,
        body="""select name as target_name, entity_id as target_id, sku as target_sku from cat_names
where name in (select d.products_name from products p join products_description d on p.products_id = d.products_id
               where p.products_model is not null and p.products_model != '')""",
    ),
)
def q_migration_record_matches(spark, d):
    """Every catalogue product whose name a legacy product has."""
    t = Tables(spark, d)
    return reconciliation_job(product_src(t), catalogue_tgt(t), CFG, legacy_set_id=2)["migration_record_matches"]


@register(
    "legacy_attribute_rows",
    with_ctes(
        PRODUCTS_SQL,
        body="""select products_name as value, 71 as attribute_id, p.products_id as entity_id, 4 as entity_type_id, 0 as store_id
from products p join products_description d on p.products_id = d.products_id""",
    ),
)
def q_legacy_attribute_rows(spark, d):
    t = Tables(spark, d)
    return PR.legacy_products_job(product_src(t), legacy_tgt(t), CFG)["catalog_product_entity_varchar"]


@register(
    "legacy_price_rows",
    with_ctes(
        PRODUCTS_SQL,
        body="""select products_price as value, 75 as attribute_id, p.products_id as entity_id, 4 as entity_type_id, 0 as store_id
from products p join products_description d on p.products_id = d.products_id""",
    ),
)
def q_legacy_price_rows(spark, d):
    t = Tables(spark, d)
    return PR.legacy_products_job(product_src(t), legacy_tgt(t), CFG)["catalog_product_entity_decimal"]


@register(
    "legacy_set_and_group",
    with_ctes(
        TYPE_FRAMES_SQL,
        body=f"""select 'set' as kind, cast(attribute_set_id as bigint) as id, attribute_set_name as name from sets
union all select 'set', (select max(attribute_set_id) + 1 from sets), '{CFG.legacy_set_name}'
union all select 'group', n_nationkey, n_name from nation
union all select 'group', (select max(n_nationkey) + 1 from nation), '{C.LEGACY_GROUP_NAME}'""",
    ),
)
def q_legacy_set_and_group(spark, d):
    out = PR.legacy_attribute_set(spark, legacy_tgt(Tables(spark, d)), CFG)[0]
    sets, groups = out["eav_attribute_set"], out["eav_attribute_group"]
    return sets.select(F.lit("set").alias("kind"), F.col("attribute_set_id").cast("long").alias("id"), F.col("attribute_set_name").alias("name")).unionByName(
        groups.select(F.lit("group").alias("kind"), F.col("attribute_group_id").cast("long").alias("id"), F.col("attribute_group_name").alias("name"))
    )
