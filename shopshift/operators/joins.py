"""Join shapes of a migration: star staging, filtered right sides, computed keys, name reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(
    fact: DataFrame,
    dimensions: Sequence[tuple[DataFrame, Column | str | Sequence[str], str]],
) -> DataFrame:
    """A fact joined to dimension tables, in the given order.

    Each entry is (dimension, join condition, how).  Literal lookups carry
    their broadcast hint; of the others Spark broadcasts those whose size it
    knows, or measures, to be below its threshold.
    """
    out = fact
    for dim, cond, how in dimensions:
        out = out.join(dim, cond, how)
    return out


def join_filtered_right(
    left: DataFrame, right: DataFrame, on, right_filter: Column, how: str = "left"
) -> DataFrame:
    """A join whose ON clause also holds a predicate on the right side only.

    The predicate filters the right side before the join, so for a left join
    every left row is kept (unlike a WHERE after the join), and the filter is
    pushed into the right side's scan.
    """
    return left.join(right.filter(right_filter), on, how)


def computed_key_join(
    left: DataFrame, left_key: Column, right: DataFrame, right_key: str | Column, how: str = "inner"
) -> DataFrame:
    """Equi-join on a key computed from several left columns (e.g. a generated SKU)."""
    lk = "__computed_key"
    l2 = left.withColumn(lk, left_key)
    rk = F.col(right_key) if isinstance(right_key, str) else right_key
    return l2.join(right, l2[lk] == rk, how).drop(lk)


def typed_join(
    left: DataFrame, left_col: str, right: DataFrame, right_col: str, as_type: str, how: str = "inner"
) -> DataFrame:
    """Join keys of different declared types, both cast to ``as_type`` explicitly."""
    return left.join(right, left[left_col].cast(as_type) == right[right_col].cast(as_type), how)


def reconcile_by_name(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    how: str = "left",
) -> DataFrame:
    """Match rows by a text name.

    Every left row is kept (NULLs when nothing matches); a name present
    several times on the right yields one output row per match, which is the
    meaning of the reconciliation.  A very common name is a hot key: the join
    relies on AQE's skew handling to split it across tasks.
    """
    return left.join(right, left[left_name] == right[right_name], how)


def reconcile_grouped(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    count_col: str = "match_count",
) -> tuple[DataFrame, DataFrame]:
    """J10, exact grouped form: (left rows with their match count, right rows whose name a left row has).

    Holds the same information as the pair join in ``len(left) + len(right)``
    rows instead of ``sum(L_name * R_name)``: what matched is all that shares
    the name.  Either side is reduced to one row per name before it is joined
    (partial aggregation), so both joins are many-to-one and a hot name is one
    build row, not a group to pair up.
    """
    counts = right.groupBy(F.col(right_name).alias("__name")).agg(F.count(F.lit(1)).alias(count_col))
    matched = left.join(counts, left[left_name] == counts["__name"], "left").drop("__name")
    matched = matched.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)))
    names = left.select(F.col(left_name).alias("__name")).distinct()
    return matched, right.join(names, right[right_name] == names["__name"], "left_semi")
