"""Row updates re-expressed as column rewrites.

An ``UPDATE t, s SET t.c = f(s) WHERE join AND cond`` becomes a left join of
``t`` with ``s`` followed by ``when(matched and cond, f(s)).otherwise(t.c)``
per assigned column: no row is rewritten in place, the result is a new frame.
Updates that read columns written by an earlier update must be applied in
the same order (the frames are simply chained).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCH = "__matched"


def update_from(
    target: DataFrame,
    source: DataFrame | None,
    on: Sequence[str] | None,
    condition: Column | None,
    assignments: Mapping[str, Column],
) -> DataFrame:
    """Overwrite ``assignments`` where a source row matches and ``condition`` holds.

    ``source`` must hold at most one row per ``on`` key (aggregate it first,
    e.g. with ``pick_first``); its columns are visible to ``condition`` and to
    the assignments under their own names, so give them distinct names.
    A NULL condition leaves the row unchanged.
    """
    if source is not None:
        src = source.select(*on, F.lit(True).alias(MATCH), *[c for c in source.columns if c not in on])
        joined = target.join(src, list(on), "left")
        hit = F.coalesce(F.col(MATCH), F.lit(False))
    else:
        joined = target
        hit = F.lit(True)
    if condition is not None:
        hit = hit & F.coalesce(condition, F.lit(False))
    flag = "__update_hit"
    joined = joined.withColumn(flag, hit)
    out_cols = []
    for name in target.columns:
        if name in assignments:
            old = F.col(name)
            new = assignments[name].cast(target.schema[name].dataType)
            out_cols.append(F.when(F.col(flag), new).otherwise(old).alias(name))
        else:
            out_cols.append(F.col(name))
    return joined.select(*out_cols)


def pick_first(
    source: DataFrame,
    key: str | Sequence[str],
    values: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """U3 tie rule: for each key, the values of the row that comes first by ``order_by``.

    A grouped ``min_by`` (partial aggregation before the shuffle, so a hot
    key costs one row per task, not its whole group).
    """
    keys = [key] if isinstance(key, str) else list(key)
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(o) for o in order_by]))
    return source.groupBy(*keys).agg(picked.alias("__pick")).select(*keys, "__pick.*")
