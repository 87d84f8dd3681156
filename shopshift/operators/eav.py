"""Entity-attribute-value: wide rows to typed (attribute, value) rows in one pass.

A legacy migration writes one INSERT ... SELECT per attribute, i.e. one scan
of the staged table per attribute; Catalyst does not merge those unions.
``wide_to_eav`` emits every attribute of a row from a single scan with the
``stack`` generator (NULL values are kept, as the per-attribute inserts keep
them).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wide_to_eav(
    df: DataFrame,
    entity: str | Column,
    attributes: Mapping[int, str | Column],
    value_type: str,
    constants: Mapping[str, object] | None = None,
    entity_col: str = "entity_id",
    value_col: str = "value",
    attribute_col: str = "attribute_id",
    where: Mapping[int, Column] | None = None,
) -> DataFrame:
    """P5: one output row per (input row, attribute) holding that attribute's value.

    ``attributes`` maps attribute id -> source column (or expression); every
    value is cast to ``value_type``.  ``constants`` are added as literal
    columns (entity type id, store id, ...).  ``where`` optionally restricts
    an attribute to rows meeting a predicate (rows failing it emit nothing
    for that attribute).
    """
    if not attributes:
        raise ValueError("no attributes to unpivot")
    where = dict(where or {})
    pairs: list[Column] = []
    for attr_id, src in attributes.items():
        pairs += [F.lit(int(attr_id)).cast("int"), _c(src).cast(value_type)]
    if not where:
        gen = F.stack(F.lit(len(attributes)), *pairs).alias(attribute_col, value_col)
        out = df.select(_c(entity).alias(entity_col), gen)
    else:
        # a keep-flag per attribute as a third stacked field, filtered on and dropped
        triples: list[Column] = []
        for i, attr_id in enumerate(attributes):
            keep = F.coalesce(where.get(attr_id, F.lit(True)), F.lit(False))
            triples += [pairs[2 * i], pairs[2 * i + 1], keep]
        gen = F.stack(F.lit(len(attributes)), *triples).alias(attribute_col, value_col, "__keep")
        out = df.select(_c(entity).alias(entity_col), gen).filter(F.col("__keep")).drop("__keep")
    for name, v in (constants or {}).items():
        out = out.withColumn(name, v if isinstance(v, Column) else F.lit(v))
    return out.select(value_col, attribute_col, entity_col, *list(constants or {}))


def constant_attribute(
    df: DataFrame,
    entity: str | Column,
    attribute_id: int,
    value,
    constants: Mapping[str, object] | None = None,
    entity_col: str = "entity_id",
) -> DataFrame:
    """One EAV row per entity with a fixed value (e.g. status enabled)."""
    cols = [F.lit(value).alias("value"), F.lit(int(attribute_id)).alias("attribute_id"), _c(entity).alias(entity_col)]
    cols += [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    return df.select(*cols)


def resolve_attribute_ids(catalog: DataFrame, codes: Iterable[str]) -> dict[str, int]:
    """Attribute code -> id, read once from the dictionary.

    Replaces a constant-only join per attribute: a code missing from the
    dictionary yields no id, so the attribute emits no rows, as the join would.
    A code present twice is an error (the join would duplicate every row).
    """
    codes = list(dict.fromkeys(codes))
    # one row per wanted code
    rows = (
        catalog.filter(F.col("attribute_code").isin(codes))
        .groupBy("attribute_code")
        .agg(F.min("attribute_id").alias("attribute_id"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    twice = [r["attribute_code"] for r in rows if r["n"] > 1]
    if twice:
        raise ValueError(f"attribute codes {sorted(twice)!r} are not unique in the dictionary")
    return {r["attribute_code"]: int(r["attribute_id"]) for r in rows}


def eav_view(values: DataFrame, entities: DataFrame, attribute_id: int, entity_col: str = "entity_id") -> DataFrame:
    """Attribute values of one attribute joined to their entity rows.

    A left join followed by a NULL-rejecting filter on the entity side is an
    inner join; written as one so that no outer rows are built and dropped.
    """
    vals = values.filter(F.col("attribute_id") == attribute_id)
    return vals.join(entities, entity_col, "inner")


def eav_with_fallback(
    values: DataFrame,
    attributes: Mapping[str, int],
    store_id: int,
    default_store: int = 0,
    entity_col: str = "entity_id",
) -> DataFrame:
    """One row per entity with a column per attribute, as a store sees it.

    The value of the store itself, else (no row, or NULL) that of
    ``default_store``; NULL if neither has one.  Of several rows of one
    (entity, attribute, store) the smallest value counts.  Entities without a
    row of these attributes in either store have no row.  One scan, filtered to
    the attributes and stores, and one grouped aggregate in place of two left
    joins per attribute.
    """
    if not attributes:
        raise ValueError("no attributes to read")
    stores = [store_id, default_store]
    rows = values.filter(F.col("attribute_id").isin([int(a) for a in attributes.values()]) & F.col("store_id").isin(stores))
    aggs = []
    for code, attribute_id in attributes.items():
        hit = F.col("attribute_id") == int(attribute_id)
        own = F.min(F.when(hit & (F.col("store_id") == store_id), F.col("value")))
        default = F.min(F.when(hit & (F.col("store_id") == default_store), F.col("value")))
        aggs.append(F.coalesce(own, default).alias(code))
    return rows.groupBy(entity_col).agg(*aggs)
