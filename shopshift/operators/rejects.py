"""Rows that cannot be migrated go to a table of their own, with the reasons, instead of failing the run or vanishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopshift.sources.tables import materialise

REASONS = "reasons"


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reasons``: the names of the rules it meets, in their order (a rule that is NULL is not met)."""
    return df.withColumn(REASONS, F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]).cast("array<string>")))


def split_rejects(df: DataFrame, rules: Mapping[str, Column], unique: Mapping[str, Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rejects with ``reasons``): every row of ``df`` is in one of the two.

    ``rules`` maps a reason to a condition on a row.  ``unique`` maps a reason
    to key columns: all rows of a key that several rows have are rejected for
    it (NULL is a key).  The rows are computed and scanned once and written as
    a stage; repeated keys are counted on the stage's key columns, partially
    before the shuffle, and only they are joined back.
    """
    staged = materialise(with_reasons(df, rules), "rejects")
    for reason, keys in (unique or {}).items():
        several = staged.groupBy(F.struct(*keys).alias("__key")).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").select("__key")
        # names of the rows' own columns may be anything
        rows = staged.select(F.struct(*df.columns).alias("__own"), REASONS, F.struct(*keys).alias("__same"))
        marked = rows.join(several, F.col("__same").eqNullSafe(F.col("__key")), "left")
        reasons = F.when(F.col("__key").isNotNull(), F.array_append(REASONS, F.lit(reason))).otherwise(F.col(REASONS))
        staged = marked.select("__own.*", reasons.alias(REASONS))
    return staged.filter(F.size(REASONS) == 0).drop(REASONS), staged.filter(F.size(REASONS) > 0)


def too_long(column: str, limit: int) -> Column:
    """A text of more characters than its target column holds."""
    return F.char_length(F.col(column)) > limit
