"""Reshaping: projections, fan-out, replication, role rows and the class pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def fan_out(df: DataFrame, copies: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Each source column copied to several target columns."""
    cols = [F.col(k) for k in keep]
    for src, targets in copies.items():
        cols += [F.col(src).alias(t) for t in targets]
    return df.select(*cols)


def replicate(df: DataFrame, col: str, values: Sequence, keep: Sequence[str] | None = None) -> DataFrame:
    """The same rows once per constant value (e.g. store 0 and store 1)."""
    base = [F.col(k) for k in keep] if keep is not None else [F.col(k) for k in df.columns]
    return df.select(*base, F.explode(F.array(*[F.lit(v) for v in values])).alias(col))


def role_rows(
    df: DataFrame,
    roles: Mapping[str, Mapping[str, object]],
    role_col: str = "address_type",
    keep: Mapping[str, object] | None = None,
) -> DataFrame:
    """One wide row -> one row per role (shipping and billing address rows).

    ``roles`` maps role label -> {target column: source}; every role must
    name the same target columns.  ``keep`` adds shared columns to each row.
    """
    labels = list(roles)
    targets = list(roles[labels[0]])
    for lab in labels[1:]:
        if list(roles[lab]) != targets:
            raise ValueError("every role must map the same target columns")
    structs = [
        F.struct(*[_c(roles[lab][t]).alias(t) for t in targets], F.lit(lab).alias(role_col)) for lab in labels
    ]
    shared = [_c(v).alias(k) for k, v in (keep or {}).items()]
    exploded = df.select(*shared, F.inline(F.array(*structs)))
    return exploded


def class_pivot(
    rows: DataFrame,
    key: str,
    class_col: str,
    classes: Mapping[str, Mapping[str, str]],
    on_duplicate: str = "error",
    rows_col: str | None = None,
) -> DataFrame:
    """Class-keyed rows -> one row per key with a column per (class, value).

    ``classes`` maps class value -> {output column: value column}.  One pass
    (a single grouped aggregate with conditional aggregates) replaces one left
    join of the row table per class.  The input must hold at most one row per
    (key, class): with ``on_duplicate="error"`` a violation fails the job,
    with ``"min"`` the smallest row is taken (its columns compared in the order
    they are given).  Only the wanted classes are read (the class filter
    reaches the scan).  ``rows_col`` adds the number of the key's rows read.

    One scan and one shuffle of partial aggregates.  In ``"error"`` mode each
    column is a minimum of its own, hash-aggregated where all are numbers; the
    whole-row minimum of ``"min"`` needs a sort-based aggregate.
    """
    if on_duplicate not in ("error", "min"):
        raise ValueError("on_duplicate must be 'error' or 'min'")
    src = rows.filter(F.col(class_col).isin(list(classes)))
    aggs, outs = [F.count(F.lit(1)).alias(rows_col)] if rows_col else [], []
    for i, (cls, names) in enumerate(classes.items()):
        hit = F.col(class_col) == F.lit(cls)
        if on_duplicate == "min":
            # the columns of a class come from one row
            aggs.append(F.min(F.when(hit, F.struct(*[F.col(v).alias(f"c{j}") for j, v in enumerate(names.values())]))).alias(f"__class{i}"))
            outs += [F.col(f"__class{i}.c{j}").alias(out) for j, out in enumerate(names)]
            continue
        aggs.append(F.count_if(hit).alias(f"__class{i}"))
        several = F.raise_error(F.lit(f"class_pivot: several rows of class {cls} for one {key}"))
        for out, v in names.items():
            aggs.append(F.min(F.when(hit, F.col(v))).alias(out))
            outs.append(F.when(F.col(f"__class{i}") > 1, several).otherwise(F.col(out)).alias(out))
    return src.groupBy(key).agg(*aggs).select(key, *outs, *([rows_col] if rows_col else []))
