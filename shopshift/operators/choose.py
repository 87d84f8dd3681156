"""One whole row of a group, chosen the same way every time, and a count of the rows that were not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def choose_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), unused_col: str | None = None) -> DataFrame:
    """One row of ``df`` per ``keys``: the first by ``order``, then by its other columns as they stand.

    All columns of a result come from one row, whatever the partitioning; of
    equal rows it does not matter which.  NULL comes first in ``order`` (use
    ``col.isNull()`` before a column to have it last).  NULL keys are a group.
    ``unused_col`` adds the number of the group's other rows.

    One grouped minimum, partial before the shuffle: a hot key costs a row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    aggs = [F.min(row).alias("__row")]
    if unused_col:
        aggs.append((F.count(F.lit(1)) - 1).alias(unused_col))
    chosen = df.groupBy(*keys).agg(*aggs)
    return chosen.select(*keys, *[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(rest)], *([unused_col] if unused_col else []))
