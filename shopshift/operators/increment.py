"""Grouped results kept up to date from a snapshot difference instead of a full run.

A state is an ordinary frame, one row per key.  What changed comes from
:func:`shopshift.operators.diff.snapshot_diff`; untouched keys pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.operators.diff import changes_only
from shopshift.operators.reshape import class_pivot

ROWS = "class_rows"


def merge_counts(state: DataFrame, diff: DataFrame, key: str, name: str = "product_count") -> DataFrame:
    """A1 kept up to date: ``state`` (key, count) after ``diff``, whose keys hold ``key``; keys without rows go."""
    delta = changes_only(diff).groupBy(key).agg(F.sum(F.col("rows_new") - F.col("rows_old")).alias("__delta"))
    delta = delta.filter("__delta != 0").withColumnRenamed(key, "__key")
    merged = state.join(delta, F.col(key).eqNullSafe(F.col("__key")), "full_outer")
    # a key is NULL for an inserted key, and for the NULL key itself
    count = (F.coalesce(name, F.lit(0)) + F.coalesce("__delta", F.lit(0))).cast("long")
    return merged.select(F.coalesce(key, "__key").alias(key), count.alias(name)).filter(F.col(name) > 0)


def pivot_state(rows: DataFrame, key: str, class_col: str, classes: Mapping[str, Mapping[str, str]], on_duplicate: str = "error") -> DataFrame:
    """J6 with ``class_rows``, the number of the key's rows of the wanted classes: a pivot that can be kept up to date."""
    return class_pivot(rows, key, class_col, classes, on_duplicate, rows_col=ROWS)


def merge_pivot(
    state: DataFrame, diff: DataFrame, key: str, class_col: str, classes: Mapping[str, Mapping[str, str]], on_duplicate: str = "error"
) -> DataFrame:
    """:func:`pivot_state` after ``diff``, a difference by (key, class) that carries the pivot's value columns.

    The columns of a class that changed are replaced, or NULL if its row is
    gone; a key without rows goes.  Several rows of one class for one key are
    treated as :func:`class_pivot` treats them.
    """
    if on_duplicate not in ("error", "min"):
        raise ValueError("on_duplicate must be 'error' or 'min'")
    carried = diff.schema["after"].dataType.fieldNames()
    if on_duplicate == "min" and any(list(outs.values()) != carried[: len(outs)] for outs in classes.values()):
        raise ValueError("the difference must carry the classes' columns first, in their order")
    changed = changes_only(diff).filter(F.col(class_col).isin(list(classes)))
    if on_duplicate == "error":
        several = F.raise_error(F.concat(F.lit("class_pivot: several rows of class "), F.col(class_col), F.lit(f" for one {key}")))
        # raise_error has no type of its own
        changed = changed.withColumn("rows_new", F.when(F.col("rows_new") > 1, several.cast("long")).otherwise(F.col("rows_new")))
    aggs = [F.sum(F.col("rows_new") - F.col("rows_old")).alias("__delta")]
    for i, (cls, outs) in enumerate(classes.items()):
        hit = F.col(class_col) == F.lit(cls)
        aggs.append(F.max(F.when(hit, F.lit(True))).alias(f"__hit{i}"))
        # one row per (key, class)
        aggs += [F.min(F.when(hit, F.col(f"after.{v}"))).alias(f"__new_{out}") for out, v in outs.items()]
    touched = changed.groupBy(F.col(key).alias("__key")).agg(*aggs)
    merged = state.join(touched, F.col(key).eqNullSafe(F.col("__key")), "full_outer")
    cols = [
        F.when(F.col(f"__hit{i}"), F.col(f"__new_{out}")).otherwise(F.col(out)).alias(out)
        for i, outs in enumerate(classes.values())
        for out in outs
    ]
    rows = (F.coalesce(ROWS, F.lit(0)) + F.coalesce("__delta", F.lit(0))).cast("long").alias(ROWS)
    return merged.select(F.coalesce(key, "__key").alias(key), *cols, rows).filter(F.col(ROWS) > 0)
