"""Registry of named checks: Spark query (library operators) + DuckDB oracle SQL.

Every query reads whole test tables (or frames Spark derives from them); the
oracle states the same result in plain SQL, written the way the legacy
scripts would (one join per class, one insert per attribute, row_number for
keys), so that the two sides are computed independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.checks import standins as S
from shopshift.checks.standins import Tables, with_ctes
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.aggregate import distinct_rows, group_count
from shopshift.operators.lookups import map_codes, unmapped_report
from shopshift.operators.reshape import class_pivot, replicate
from shopshift.sinks.writers import conform
from shopshift.sources.tables import attribute_catalog, inline_lookup, load_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


# Check configuration: which legacy status codes map (one is left unmapped on purpose).
CHECK_STATUS_MAP = [("O", "pending"), ("F", "complete")]
CHECK_CLASSES = {"A": {"total_a": "value"}, "N": {"total_n": "value"}, "R": {"total_r": "value"}}
STATUS_VALUES_SQL = "(select * from (values ('O', 'pending'), ('F', 'complete')) as m(code, status))"


def _status_lookup(spark: SparkSession) -> DataFrame:
    return inline_lookup(spark, "code string, status string", CHECK_STATUS_MAP)


# ---------------------------------------------------------------------------
# Flagship: order staging (status lookup, customer, item count, class pivot)
# ---------------------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    mapped = map_codes(o, _status_lookup(spark), "o_orderstatus", "code")
    cust = t.customer.select("c_custkey", "c_name")
    with_cust = mapped.join(cust, mapped["o_custkey"] == cust["c_custkey"], "left")
    counts = group_count(t.lineitem, "l_orderkey", "item_count").withColumnRenamed("l_orderkey", "o_orderkey")
    totals = class_pivot(S.v_totals(t), "orders_id", "class", CHECK_CLASSES).withColumnRenamed("orders_id", "o_orderkey")
    staged = with_cust.join(counts, "o_orderkey", "left").join(totals, "o_orderkey", "left")
    return staged.select("o_orderkey", "status", "c_name", "item_count", "total_a", "total_n", "total_r")


register(
    "orders_stage",
    with_ctes(
        S.V_TOTALS,
        "cnt as (select l_orderkey, count(*) as item_count from lineitem group by l_orderkey)",
        body=f"""select o.o_orderkey, m.status, c.c_name, cnt.item_count,
       ta.value as total_a, tn.value as total_n, tr.value as total_r
from orders o
join {STATUS_VALUES_SQL} m on o.o_orderstatus = m.code
left join customer c on o.o_custkey = c.c_custkey
left join cnt on o.o_orderkey = cnt.l_orderkey
left join v_totals ta on o.o_orderkey = ta.orders_id and ta.class = 'A'
left join v_totals tn on o.o_orderkey = tn.orders_id and tn.class = 'N'
left join v_totals tr on o.o_orderkey = tr.orders_id and tr.class = 'R'""",
    ),
)(flagship)


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------

@register("scan_customer", "select c_custkey, c_name, c_nationkey from customer")
def q_scan_customer(spark, d):
    return load_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])


@register(
    "attribute_catalog",
    with_ctes(S.V_ATTRIBUTES, body="select attribute_id, attribute_code from v_attributes where entity_type_id = 4"),
)
def q_attribute_catalog(spark, d):
    return attribute_catalog(S.v_attributes(Tables(spark, d)), 4)


_STATUS_ID_VALUES = ", ".join(f"({i}, '{s}')" for i, s in C.ORDER_STATUS_MAP)


@register(
    "lookup_status_map",
    f"""select o_orderkey, cast(o_orderkey % 10 as integer) as legacy_status_id, m.status
from orders join (select * from (values {_STATUS_ID_VALUES}) as m(sid, status)) m
  on cast(o_orderkey % 10 as integer) = m.sid""",
)
def q_lookup_status_map(spark, d):
    """The configured order-status lookup applied to a status id derived from each order."""
    o = Tables(spark, d).orders.select("o_orderkey", (F.col("o_orderkey") % 10).cast("int").alias("legacy_status_id"))
    lk = inline_lookup(spark, "sid int, status string", C.ORDER_STATUS_MAP)
    return map_codes(o, lk, "legacy_status_id", "sid")


# ---------------------------------------------------------------------------
# Lookups, counts, outer joins, class pivot
# ---------------------------------------------------------------------------

@register(
    "orders_status_mapped",
    f"select o.o_orderkey, o.o_orderstatus, m.status from orders o join {STATUS_VALUES_SQL} m on o.o_orderstatus = m.code",
)
def q_orders_status_mapped(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return map_codes(o, _status_lookup(spark), "o_orderstatus", "code")


@register(
    "status_unmapped",
    f"select o_orderkey, o_orderstatus from orders o where not exists "
    f"(select 1 from {STATUS_VALUES_SQL} m where m.code = o.o_orderstatus)",
)
def q_status_unmapped(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return unmapped_report(o, _status_lookup(spark), "o_orderstatus", "code")


@register(
    "order_product_count",
    "select l_orderkey as orders_id, count(*) as product_count from lineitem group by l_orderkey",
)
def q_order_product_count(spark, d):
    li = Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("orders_id"))
    return group_count(li, "orders_id", "product_count")


@register(
    "orders_with_item_count",
    """select o.o_orderkey, c.item_count from orders o
left join (select l_orderkey, count(*) as item_count from lineitem group by l_orderkey) c
  on o.o_orderkey = c.l_orderkey""",
)
def q_orders_with_item_count(spark, d):
    t = Tables(spark, d)
    counts = group_count(t.lineitem, "l_orderkey", "item_count").withColumnRenamed("l_orderkey", "o_orderkey")
    return t.orders.select("o_orderkey").join(counts, "o_orderkey", "left")


@register(
    "class_pivot",
    with_ctes(
        S.V_TOTALS,
        body="""select o.o_orderkey, ta.value as total_a, tn.value as total_n, tr.value as total_r
from orders o
left join v_totals ta on o.o_orderkey = ta.orders_id and ta.class = 'A'
left join v_totals tn on o.o_orderkey = tn.orders_id and tn.class = 'N'
left join v_totals tr on o.o_orderkey = tr.orders_id and tr.class = 'R'""",
    ),
)
def q_class_pivot(spark, d):
    t = Tables(spark, d)
    totals = class_pivot(S.v_totals(t), "orders_id", "class", CHECK_CLASSES).withColumnRenamed("orders_id", "o_orderkey")
    return t.orders.select("o_orderkey").join(totals, "o_orderkey", "left")


MIN_CLASSES = {c: {f"{c.lower()}_price": "price", f"{c.lower()}_part": "part"} for c in "ANR"}
_CHEAPEST = """(select l_orderkey, l_returnflag, price, l_partkey as part from
  (select *, cast(l_extendedprice as decimal(18,2)) as price,
          row_number() over (partition by l_orderkey, l_returnflag order by cast(l_extendedprice as decimal(18,2)), l_partkey) as place
   from lineitem) x where place = 1)"""


@register(
    "class_pivot_min",
    f"""select l_orderkey as orders_id,
       any_value(price) filter (l_returnflag = 'A') as a_price, any_value(part) filter (l_returnflag = 'A') as a_part,
       any_value(price) filter (l_returnflag = 'N') as n_price, any_value(part) filter (l_returnflag = 'N') as n_part,
       any_value(price) filter (l_returnflag = 'R') as r_price, any_value(part) filter (l_returnflag = 'R') as r_part
from {_CHEAPEST} c group by l_orderkey""",
)
def q_class_pivot_min(spark, d):
    """Several rows of one class for one order: the columns of a class come from its smallest row."""
    rows = Tables(spark, d).lineitem.select(
        F.col("l_orderkey").alias("orders_id"), F.col("l_returnflag").alias("class"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_partkey").alias("part"),
    )
    return class_pivot(rows, "orders_id", "class", MIN_CLASSES, on_duplicate="min")


# ---------------------------------------------------------------------------
# Customers: name helpers, one-pass name values
# ---------------------------------------------------------------------------

_SPLIT_FIRST = "substring({s}, 1, greatest(strpos({s}, ' ') - 1, 0))"
_SPLIT_LAST = "substring({s}, strpos({s}, ' ') + 1)"


@register(
    "name_split",
    with_ctes(
        S.V_CUSTOMERS,
        body=f"""select customers_id, {_SPLIT_FIRST.format(s='full_name')} as first_name,
       {_SPLIT_LAST.format(s='full_name')} as last_name from v_customers""",
    ),
)
def q_name_split(spark, d):
    v = S.v_customers(Tables(spark, d))
    first, last = X.split_full_name("full_name")
    return v.select("customers_id", first.alias("first_name"), last.alias("last_name"))


@register(
    "name_fallback",
    with_ctes(
        S.V_CUSTOMERS,
        body=f"""select customers_id,
       coalesce(firstname, {_SPLIT_FIRST.format(s='full_name')}) as customers_firstname,
       coalesce(lastname, {_SPLIT_LAST.format(s='full_name')}) as customers_lastname from v_customers""",
    ),
)
def q_name_fallback(spark, d):
    v = S.v_customers(Tables(spark, d))
    first, last = X.name_with_fallback("firstname", "lastname", "full_name")
    return v.select("customers_id", first.alias("customers_firstname"), last.alias("customers_lastname"))


@register(
    "street_lines",
    with_ctes(
        S.V_CUSTOMERS,
        body="select customers_id, concat_ws(chr(10), full_name, nullif(suburb, '')) as street from v_customers",
    ),
)
def q_street_lines(spark, d):
    v = S.v_customers(Tables(spark, d))
    return v.select("customers_id", X.street_lines("full_name", "suburb").alias("street"))


@register(
    "customer_names_eav",
    with_ctes(
        S.V_CUSTOMERS,
        body="""select firstname as value, 5 as attribute_id, customers_id as entity_id, 1 as entity_type_id from v_customers
union all
select lastname, 7, customers_id, 1 from v_customers""",
    ),
)
def q_customer_names_eav(spark, d):
    """B1 name values: first and last name from one scan of the customers."""
    from shopshift.plans.customers import customers_job

    v = S.v_customers(Tables(spark, d))
    src = {
        "customers": v.select(
            "customers_id",
            F.lit(None).cast("string").alias("customers_email_address"),
            F.col("firstname").alias("customers_firstname"),
            F.col("lastname").alias("customers_lastname"),
        )
    }
    return customers_job(src, C.MigrationConfig())["customer_entity_varchar"]


@register(
    "filter_present",
    with_ctes(S.V_CUSTOMERS, body="select customers_id, suburb from v_customers where suburb is not null and suburb <> ''"),
)
def q_filter_present(spark, d):
    v = S.v_customers(Tables(spark, d))
    return v.filter(P.present("suburb")).select("customers_id", "suburb")


# ---------------------------------------------------------------------------
# Addresses: star join staging, eight values in one pass, region ids, default links
# ---------------------------------------------------------------------------

def address_src(t: Tables) -> dict[str, DataFrame]:
    c = t.customer
    k = F.col("c_custkey")
    return {
        "address_book": c.select(
            k.alias("address_book_id"),
            k.alias("customers_id"),
            F.col("c_mktsegment").alias("entry_company"),
            F.col("c_mktsegment").alias("entry_firstname"),
            F.col("c_name").alias("entry_lastname"),
            F.concat(F.lit("Street "), k.cast("string")).alias("entry_street_address"),
            F.when(k % 2 == 0, F.lit("")).when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("entry_suburb"),
            F.lpad(k.cast("string"), 5, "0").alias("entry_postcode"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("entry_city"),
            (F.col("c_nationkey") * 5).alias("entry_zone_id"),
            (F.col("c_nationkey") % 5).alias("entry_country_id"),
        ),
        "customers": c.select(
            k.alias("customers_id"),
            (F.lit(900000) + k).alias("customers_default_address_id"),
            F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), k.cast("string")).alias("customers_telephone"),
        ),
        "zones": t.nation.select((F.col("n_nationkey") * 5).alias("zone_id"), F.col("n_name").alias("zone_name")),
        "countries": t.region.select(
            F.col("r_regionkey").alias("countries_id"), F.substring("r_name", 1, 2).alias("countries_iso_code_2")
        ),
    }


ADDRESS_STAGE_SQL = """address_stage as (
  select c.c_custkey as address_book_id, c.c_custkey as customers_id,
         900000 + c.c_custkey as customers_default_address_id,
         c.c_mktsegment as entry_company, c.c_mktsegment as entry_firstname, c.c_name as entry_lastname,
         'Street ' || cast(c.c_custkey as varchar) as entry_street_address,
         case when c.c_custkey % 2 = 0 then '' when c.c_custkey % 3 = 0 then null else c.c_mktsegment end as entry_suburb,
         lpad(cast(c.c_custkey as varchar), 5, '0') as entry_postcode,
         'City ' || cast(c.c_nationkey as varchar) as entry_city,
         n.n_name as zone_name, n.n_nationkey * 5 as zone_id,
         substring(r.r_name, 1, 2) as country_code,
         cast(c.c_nationkey as varchar) || '-' || cast(c.c_custkey as varchar) as customers_telephone
  from customer c
  join nation n on c.c_nationkey * 5 = n.n_nationkey * 5
  join region r on c.c_nationkey % 5 = r.r_regionkey)"""


@register(
    "customer_addresses",
    with_ctes(
        ADDRESS_STAGE_SQL,
        body="select address_book_id, customers_id, zone_name, zone_id, country_code, customers_telephone from address_stage",
    ),
)
def q_customer_addresses(spark, d):
    from shopshift.plans.customers import addresses_stage

    st = addresses_stage(address_src(Tables(spark, d)))
    return st.select("address_book_id", "customers_id", "zone_name", "zone_id", "country_code", "customers_telephone")


_ADDR_VARCHAR_SQL = "\nunion all\n".join(
    f"select {col} as value, {C.ADDRESS_ATTR[k]} as attribute_id, address_book_id as entity_id, 2 as entity_type_id from address_stage"
    for k, col in [
        ("firstname", "entry_firstname"),
        ("lastname", "entry_lastname"),
        ("company", "entry_company"),
        ("city", "entry_city"),
        ("region", "zone_name"),
        ("country_id", "country_code"),
        ("postcode", "entry_postcode"),
        ("telephone", "customers_telephone"),
    ]
)


@register("address_varchar", with_ctes(ADDRESS_STAGE_SQL, body=_ADDR_VARCHAR_SQL))
def q_address_varchar(spark, d):
    from shopshift.plans.customers import addresses_job

    return addresses_job(address_src(Tables(spark, d)), C.MigrationConfig())["customer_address_entity_varchar"]


@register(
    "address_street",
    with_ctes(
        ADDRESS_STAGE_SQL,
        body="""select concat_ws(chr(10), entry_street_address, nullif(entry_suburb, '')) as value,
       25 as attribute_id, address_book_id as entity_id, 2 as entity_type_id from address_stage""",
    ),
)
def q_address_street(spark, d):
    from shopshift.plans.customers import addresses_job

    return addresses_job(address_src(Tables(spark, d)), C.MigrationConfig())["customer_address_entity_text"]


@register(
    "address_region_id",
    with_ctes(
        ADDRESS_STAGE_SQL,
        body="""select zone_id as value, 29 as attribute_id, address_book_id as entity_id, 2 as entity_type_id
from address_stage where zone_id <= 78""",
    ),
)
def q_address_region_id(spark, d):
    from shopshift.plans.customers import addresses_job

    return addresses_job(address_src(Tables(spark, d)), C.MigrationConfig())["customer_address_entity_int"]


@register(
    "default_address",
    with_ctes(
        ADDRESS_STAGE_SQL,
        body="""select distinct customers_default_address_id as value, 13 as attribute_id, customers_id as entity_id, 1 as entity_type_id from address_stage
union all
select distinct customers_default_address_id, 14, customers_id, 1 from address_stage""",
    ),
)
def q_default_address(spark, d):
    from shopshift.plans.customers import addresses_job

    return addresses_job(address_src(Tables(spark, d)), C.MigrationConfig())["customer_entity_int"]


@register(
    "segment_links",
    """select distinct c_nationkey as value, 13 as attribute_id, c_mktsegment as entity_id from customer
union all
select distinct c_nationkey, 14, c_mktsegment from customer""",
)
def q_segment_links(spark, d):
    """A2: distinct rows including constants, over a key with many duplicates."""
    c = Tables(spark, d).customer
    pairs = distinct_rows(c, [F.col("c_nationkey").alias("value"), F.col("c_mktsegment").alias("entity_id")])
    return replicate(pairs, "attribute_id", [13, 14])


# checks of the other areas register themselves on import
from shopshift.checks import catalog_checks  # noqa: E402,F401
from shopshift.checks import change_checks  # noqa: E402,F401
from shopshift.checks import order_checks  # noqa: E402,F401
from shopshift.checks import quality_checks  # noqa: E402,F401
from shopshift.checks import review_checks  # noqa: E402,F401


@register(
    "customer_entity",
    """select c_custkey as entity_id, lower(c_name) || '@example.com' as email, 1 as is_active, 1 as website_id,
       1 as group_id, 1 as store_id, 1 as entity_type_id from customer""",
)
def q_customer_entity(spark, d):
    """B1 entities conformed to the declared target schema (K1)."""
    from pyspark.sql import types as T

    from shopshift.plans.customers import customers_job

    c = Tables(spark, d).customer
    src = {
        "customers": c.select(
            F.col("c_custkey").alias("customers_id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("customers_email_address"),
            F.lit(None).cast("string").alias("customers_firstname"),
            F.lit(None).cast("string").alias("customers_lastname"),
        )
    }
    schema = T.StructType(
        [T.StructField("entity_id", T.LongType()), T.StructField("email", T.StringType())]
        + [T.StructField(n, T.IntegerType()) for n in ("is_active", "website_id", "group_id", "store_id", "entity_type_id")]
    )
    return conform(customers_job(src, C.MigrationConfig())["customer_entity"], schema)
