"""Key constraints of many tables at once: a database checks them row by row, Parquet does not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATED, ORPHAN = "repeated", "orphan"


def key_violations(
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, Sequence[str]],
    foreign: Sequence[tuple[str, Sequence[str], str]] = (),
) -> DataFrame:
    """(kind, name, key, n_rows): repeated keys and orphans of all tables, in one shuffle.

    ``primary`` maps a table to its key columns, ``foreign`` lists (table,
    columns, parent table): ``n_rows`` rows of ``name`` share a key, or refer to
    one that the parent lacks.  ``key`` holds the values as text.  A repeated
    primary key may hold NULL; a reference with a NULL is none.  Tables that
    are not in ``tables`` are left out, and with them what refers to them.

    Each table gives one narrow row (parent, key, who) per row and constraint;
    they are counted per key in one grouped aggregate, partial before the
    shuffle, so a hot key costs a row per task.
    """
    foreign = [f for f in foreign if f[0] in tables and f[2] in tables]
    primary = {t: cols for t, cols in primary.items() if t in tables}
    lacking = [f[2] for f in foreign if f[2] not in primary]
    if lacking:
        raise ValueError(f"no primary key is declared for {sorted(set(lacking))}")

    def rows(table: str, cols: Sequence[str], parent: str, who: int) -> DataFrame:
        key = F.array(*[F.col(c).cast("string") for c in cols])
        out = tables[table].select(F.lit(parent).alias("parent"), key.alias("key"), F.lit(who).alias("who"))
        return out if who < 0 else out.filter(~F.exists("key", lambda x: x.isNull()))

    parts = [rows(t, cols, t, -1) for t, cols in primary.items()]
    parts += [rows(t, cols, parent, i) for i, (t, cols, parent) in enumerate(foreign)]
    if not parts:
        raise ValueError("no table to check")
    counts = [F.count_if(F.col("who") == -1).alias("owners")]
    counts += [F.count_if(F.col("who") == i).alias(f"of{i}") for i in range(len(foreign))]
    grouped = reduce(DataFrame.unionAll, parts).groupBy("parent", "key").agg(*counts)
    found = [F.when(F.col("owners") > 1, F.struct(F.lit(REPEATED).alias("kind"), F.col("parent").alias("name"), F.col("owners").alias("n_rows")))]
    found += [
        F.when(
            (F.col("owners") == 0) & (F.col(f"of{i}") > 0) & (F.col("parent") == parent),
            F.struct(F.lit(ORPHAN).alias("kind"), F.lit(table).alias("name"), F.col(f"of{i}").alias("n_rows")),
        )
        for i, (table, _, parent) in enumerate(foreign)
    ]
    out = grouped.select("key", F.explode(F.array_compact(F.array(*found))).alias("v"))
    return out.select("v.kind", "v.name", F.concat_ws(",", F.transform("key", lambda x: F.coalesce(x, F.lit("NULL")))).alias("key"), "v.n_rows")
