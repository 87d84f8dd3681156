"""Ids that last: a stored table natural key -> id, to which a run only adds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopshift.operators.keys import assign_keys, next_key


def extend_id_map(
    known: DataFrame | None,
    rows: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    start: int = 1,
    id_col: str = "entity_id",
) -> DataFrame:
    """K5/K6: ``known`` (key columns, id) with an id for every key of ``rows`` that it lacks.

    A key keeps its id for ever, also while ``rows`` lacks it; an id is never
    given again.  New keys are numbered densely in ``order_cols`` order (which
    may name columns beside the key; ``rows`` holds a key once), from
    ``start`` or above the largest id known, whichever is more.  Only the new
    keys are sorted: those known are left out by an anti join before that.
    NULL keys are keys.
    """
    key_cols = list(key_cols)
    if known is None:
        return assign_keys(rows, order_cols, start=start, key_col=id_col).select(*key_cols, id_col)
    known = known.select(*key_cols, id_col)
    start = max(start, next_key(known, id_col))
    old = known.select(*[F.col(c).alias(f"__{c}") for c in key_cols])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key_cols]
    new = assign_keys(rows.join(old, same, "left_anti"), order_cols, start=start, key_col=id_col)
    return known.unionByName(new.select(*key_cols, F.col(id_col).cast(known.schema[id_col].dataType).alias(id_col)))


def with_ids(rows: DataFrame, id_map: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """``rows`` with the other columns of ``id_map``; a row whose key is NULL, or not in the map, goes."""
    return rows.join(id_map, list(key_cols), "inner")


class KeyConflict(ValueError):
    """Two sources would write the same generated or carried key."""


def refuse_conflicts(new: DataFrame, taken: DataFrame, what: str, id_col: str = "entity_id") -> None:
    """Fail if an id of ``new`` is one of ``taken`` (a target database would refuse the key); one row to the driver."""
    both = new.select(id_col).join(taken.select(id_col), id_col, "left_semi")
    found = both.agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    if found["n"]:
        raise KeyConflict(f"{found['n']} {what} ids from {found['lo']} to {found['hi']} belong to entities that stay")
