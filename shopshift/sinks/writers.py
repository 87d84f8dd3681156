"""Sinks: conform rows to a target schema, union inserts, refresh and replace snapshots.

Plain Parquet has no DELETE, UPDATE or identity columns, so every target is
written as a complete snapshot: the new content is computed as a DataFrame
and written to a fresh folder, which then becomes the table.  Re-running a
job therefore gives the same table (the source script was not re-runnable
for several tables).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopshift.sources.tables import VERSIONS, create_file, delete_path, logical_path, read_table, run_file, version_entries, version_log


def _as_column(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def conform(df: DataFrame, schema: T.StructType, mapping: Mapping[str, object] | None = None) -> DataFrame:
    """K1: project ``df`` onto ``schema``.

    ``mapping`` gives target column -> source column name, Column or literal.
    Target columns absent from the mapping but present in ``df`` are taken
    by name; the rest become typed NULLs (the column default).
    Every value is cast to the declared type.
    """
    mapping = dict(mapping or {})
    cols = []
    present = set(df.columns)
    for fld in schema.fields:
        if fld.name in mapping:
            c = _as_column(mapping[fld.name])
        elif fld.name in present:
            c = F.col(fld.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(fld.dataType).alias(fld.name))
    unknown = set(mapping) - {f.name for f in schema.fields}
    if unknown:
        raise ValueError(f"mapping names columns not in the target schema: {sorted(unknown)}")
    return df.select(*cols)


def append_union(dfs: Sequence[DataFrame]) -> DataFrame:
    """K2: several inserts into one target as one union (one write, one job)."""
    if not dfs:
        raise ValueError("append_union needs at least one frame")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def _widens(found: T.DataType, to: T.DataType) -> bool:
    """Whether every value of ``found`` is one of ``to``."""
    if isinstance(found, T.DecimalType) and isinstance(to, T.DecimalType):
        return found.scale <= to.scale and found.precision - found.scale <= to.precision - to.scale
    return found == to or isinstance(found, (T.NullType, T.ByteType, T.ShortType, T.IntegerType)) and isinstance(to, T.LongType)


def check_schema(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """K1: the declared columns, in declared order; fails on a column of another type or one that is not declared.

    A declared column that ``df`` lacks is its default, NULL.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: {found[f.name].simpleString()}, declared {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name in found and not _widens(found[f.name], f.dataType)
    ]
    wrong += [f"{c}: not declared" for c in found if c not in schema.fieldNames()]
    if wrong:
        raise TypeError(f"{name}: {'; '.join(wrong)}")
    return conform(df, schema)


def write_version(df: DataFrame, path: str, schema: T.StructType | None = None, name: str | None = None) -> str:
    """Write ``df`` to a new folder beside ``path``; nothing reads it before it is published.

    ``name`` tells the folder; one of that name, left by an attempt that did
    not end, is overwritten.
    """
    if schema is not None:
        df = check_schema(df, schema, path)
    target = f"{logical_path(path)}.__v{name or uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite" if name else "errorifexists").parquet(target)
    return target


def publish(spark: SparkSession, path: str, folders: Sequence[str], run_id: str | None = None, run: int | None = None) -> int:
    """Add ``folders`` as the table's next version; returns its number.

    Each number is a file of its own, created only if the name is free, so of
    two publishers one takes the next number.  With ``run`` the version counts
    once that run's record is written (:func:`commit_run`), without it at once.
    """
    log = logical_path(path) + VERSIONS
    number = max((e["version"] for e in version_entries(spark, path)), default=0) + 1
    entry = {"run_id": run_id or uuid.uuid4().hex, "folders": list(folders), "run": run}
    while not create_file(spark, f"{log}/{number:08d}.json", json.dumps({"version": number, **entry}) + "\n"):
        number += 1
    return number


class RunConflict(RuntimeError):
    """Another run was published to the same tables in the meantime."""


def commit_run(spark: SparkSession, base: str, number: int, run_id: str, tables: Sequence[str]) -> None:
    """Publish all tables of a run at once: one record, written last, makes their prepared versions count.

    ``number`` is the one after the last run that this run has read; if
    another run took it, nothing of this run is published.
    """
    if not create_file(spark, run_file(base, number), json.dumps({"run_id": run_id, "tables": sorted(tables)}) + "\n"):
        raise RunConflict(f"run {number} of {base} was published by someone else; nothing of this run counts")


def refresh(df: DataFrame, path: str, schema: T.StructType | None = None, run_id: str | None = None) -> str:
    """K3: truncate-and-load.

    The snapshot is written to a new folder beside ``path`` and then published,
    so a reader never sees a half-written table and a failed run leaves the
    previous version in place.  Returns the folder written.
    """
    target = write_version(df, path, schema)
    publish(df.sparkSession, path, [target], run_id)
    return target


def replace_where(target: DataFrame, new_rows: DataFrame, condition: Column) -> DataFrame:
    """K4: delete rows meeting ``condition``, then insert ``new_rows``.

    A row whose condition is NULL is kept, as a SQL DELETE keeps it.
    """
    kept = target.filter(~F.coalesce(condition, F.lit(False)))
    return kept.unionByName(new_rows, allowMissingColumns=True)


def record_table(df: DataFrame, schema: T.StructType, path: str | None = None) -> DataFrame:
    """K7: a permanent table with a declared schema; written when ``path`` is given."""
    out = conform(df, schema)
    if path:
        refresh(out, path)
    return out


def reset_tables(spark: SparkSession, base: str, names: Sequence[str]) -> list[str]:
    """K8: empty the named tables and keep their schemas."""
    written = []
    for name in names:
        path = f"{base.rstrip('/')}/{name}"
        written.append(refresh(read_table(spark, path).limit(0), path))
    return written


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the folders that only versions before the last ``keep`` name; returns them.

    Folders of versions before the last published one that never counted (of
    runs that failed) go too.  The log itself stays.  Folders the table had
    before its first version (``name/`` or ``name.parquet``) are not touched.
    """
    if keep < 1:
        raise ValueError("keep at least the live version")
    log, entries = version_log(spark, path), version_entries(spark, path)
    if not log:
        return []
    # what comes after the last published version may be of a run that is about to be published
    live = [v["version"] for v in log[-keep:]]
    needed = {f for v in entries if v["version"] in live or v["version"] > live[-1] for f in v["folders"]}
    gone = {f for v in entries for f in v["folders"] if f.startswith(f"{logical_path(path)}.__v")} - needed
    for folder in sorted(gone):
        delete_path(spark, folder)
    return sorted(gone)
