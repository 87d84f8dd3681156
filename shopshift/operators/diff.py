"""What changed between two snapshots of a table, by key, in one shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, CHANGED, DELETED, UNCHANGED = "inserted", "changed", "deleted", "unchanged"


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row's values; which of them are NULL is hashed too."""
    known = [F.col(c).isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *known, *[F.col(c) for c in columns]) for seed in (17, 40)]


def _same_columns(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> None:
    a, b = ({f.name: f.dataType for f in df.schema.fields} for df in (old, new))
    wrong = [c for c in columns if c not in a or c not in b or a[c] != b[c]]
    if wrong:
        raise TypeError(f"columns {wrong} are not the same in both snapshots")


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per key of either snapshot: the key, ``change``, ``rows_old``, ``rows_new``.

    ``change`` is inserted (only in ``new``), deleted (only in ``old``), changed
    or unchanged; a key that a side holds several times is unchanged if both
    hold the same rows as often, in any order.  Rows are compared by 128 bits
    of hash over ``values`` (all other columns of ``old`` by default), which
    have the same types on both sides.  NULL keys are keys, NULL values equal
    each other.  ``carry`` adds ``after``, the struct of these columns of the
    key's row in ``new`` (the smallest, if there are several; NULL if deleted).

    Both snapshots are scanned once, rows become sums per task before the one
    shuffle on the key, so a hot key costs a row per task.
    """
    keys = list(keys)
    values = [c for c in old.columns if c not in keys] if values is None else list(values)
    _same_columns(old, new, [*keys, *values])

    def tagged(df: DataFrame, sign: int) -> DataFrame:
        after = F.struct(*[F.col(c) for c in carry]) if carry and sign > 0 else None
        hashes = [h.alias(f"__h{i}") for i, h in enumerate(row_hashes(values))]
        out = df.select(*keys, F.lit(sign).cast("long").alias("__sign"), *hashes, *([after.alias("__after")] if after is not None else []))
        return out

    both = tagged(old, -1).unionByName(tagged(new, 1), allowMissingColumns=True)
    sign = F.col("__sign")
    # sums of signed halves: no overflow below 2^31 rows of a key
    halves = [half for i in (0, 1) for half in (F.shiftright(f"__h{i}", 32), F.col(f"__h{i}").bitwiseAND(F.lit(0xFFFFFFFF)))]
    aggs = [F.sum(sign * half).alias(f"__s{i}") for i, half in enumerate(halves)]
    aggs += [F.count_if(sign < 0).alias("rows_old"), F.count_if(sign > 0).alias("rows_new")]
    if carry:
        aggs.append(F.min("__after").alias("after"))
    grouped = both.groupBy(*keys).agg(*aggs)
    equal = reduce(lambda a, b: a & b, [F.col(f"__s{i}") == 0 for i in range(len(halves))], F.col("rows_old") == F.col("rows_new"))
    change = (
        F.when(F.col("rows_old") == 0, INSERTED).when(F.col("rows_new") == 0, DELETED).when(equal, UNCHANGED).otherwise(CHANGED)
    )
    return grouped.select(*keys, change.alias("change"), "rows_old", "rows_new", *(["after"] if carry else []))


def changes_only(diff: DataFrame) -> DataFrame:
    """The keys that are not unchanged."""
    return diff.filter(F.col("change") != UNCHANGED)
