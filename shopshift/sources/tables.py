"""Sources: table scans, literal lookups, one-row relations, staging, read-back."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import astuple
from functools import reduce

from py4j.protocol import Py4JJavaError

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopshift.session import ensure_checkpoint_dir


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of ``path`` in Hadoop's FileSystem API: local, HDFS, object store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system."""
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no folder."""
    fs, p = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def folder_size(spark: SparkSession, folder: str) -> tuple[int, int, int]:
    """(bytes, files, time of the last change) of a folder."""
    fs, p = _hadoop(spark, folder)
    found = fs.getContentSummary(p)
    return int(found.getLength()), int(found.getFileCount()), int(fs.getFileStatus(p).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file; empty if there is none."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return ""
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, and nothing changed, if the name is taken (atomic where the file system's create is)."""
    fs, p = _hadoop(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


VERSIONS = ".versions"


def logical_path(path: str) -> str:
    """The one name of a table whose data may lie in ``name/`` or ``name.parquet`` (its version log is beside it)."""
    return path.rstrip("/").removesuffix(".parquet")


#: Beside the tables of a base folder: one numbered file per published run.
RUNS = "_runs"


def run_file(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/{RUNS}/{number:08d}.json"


def last_run(spark: SparkSession, base: str) -> int:
    """The number of the last run published to the tables of ``base``; 0 before the first."""
    names = [n for n in list_names(spark, f"{base.rstrip('/')}/{RUNS}") if n.endswith(".json")]
    return max((int(n.split(".")[0]) for n in names), default=0)


def _published(spark: SparkSession, base: str, entry: dict) -> bool:
    """Whether an entry counts: it is of no run, or of one whose record was written."""
    if entry["run"] is None:
        return True
    record = read_text(spark, run_file(base.rsplit("/", 1)[0], entry["run"]))
    return bool(record) and json.loads(record)["run_id"] == entry["run_id"]


def version_entries(spark: SparkSession, path: str) -> list[dict]:
    """All entries of a table's version log, oldest first, also those of runs that were never published.

    Each has ``version``, ``run_id``, ``folders`` and the number of its ``run``
    (None for a table published by itself).  A log that cannot be read, or
    that holds one version number twice, is an error.
    """
    log = logical_path(path) + VERSIONS
    if not path_exists(spark, log):
        return []
    schema = "version long, run_id string, folders array<string>, run long"
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(log).collect()
    entries = sorted((r.asDict() for r in rows), key=lambda r: (r["version"] is None, r["version"]))
    numbers = [r["version"] for r in entries]
    if None in numbers or len(set(numbers)) < len(numbers) or not all(r["folders"] for r in entries):
        raise ValueError(f"the version log {log} is damaged")
    return entries


def version_log(spark: SparkSession, path: str) -> list[dict]:
    """The published versions of a table, oldest first; empty only if it has none."""
    base = logical_path(path)
    return [e for e in version_entries(spark, path) if _published(spark, base, e)]


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold a table now: those of its newest version, else ``name.parquet`` or ``name/``; none if there is no table."""
    base = logical_path(path)
    for entry in reversed(version_entries(spark, base)):
        if _published(spark, base, entry):
            return list(entry["folders"])
    return [p for p in (f"{base}.parquet", base) if path_exists(spark, p)][:1]


def read_folders(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The rows of all folders; a column that is narrower, or missing, in some is widened, or NULL."""
    frames = [spark.read.parquet(f) for f in folders]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The live content of a table (a fresh scan, never the plan that wrote it)."""
    folders = live_folders(spark, path)
    if not folders:
        raise FileNotFoundError(f"no table at {path}")
    return read_folders(spark, folders)


def load_table(spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Full scan of table ``name`` in database folder ``base``; ``columns`` prunes at the Parquet reader."""
    df = read_table(spark, f"{base.rstrip('/')}/{name}")
    return df.select(*columns) if columns else df


def inline_lookup(spark: SparkSession, schema: T.StructType | str, rows: Sequence[tuple]) -> DataFrame:
    """S3: a literal code-translation table, marked for broadcast.

    The table is built from configuration on the driver, so its size is
    known and bounded by construction; broadcasting it never grows with data.
    """
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def constant_row(spark: SparkSession, **cols) -> DataFrame:
    """A one-row relation (``select <literals>`` with no FROM)."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def constant_rows(spark: SparkSession, schema: T.StructType | str, rows: Sequence[tuple]) -> DataFrame:
    """A multi-row VALUES list."""
    return spark.createDataFrame(list(rows), schema)


def attribute_catalog(attributes: DataFrame, entity_type_id: int | Column) -> DataFrame:
    """Attribute code -> id for one entity type."""
    return attributes.filter(F.col("entity_type_id") == entity_type_id).select("attribute_id", "attribute_code")


class Stages:
    """The stages of one run: where they lie, and which an earlier attempt of the run has finished."""

    def __init__(self, spark: SparkSession, run_id: str, journal=None) -> None:
        self.spark, self.journal, self.count = spark, journal, {}
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{run_id}"

    def path(self, name: str) -> tuple[str, str]:
        """(name in the journal, folder) of the next stage of that name: a run makes its stages in one order."""
        self.count[name] = self.count.get(name, 0) + 1
        key = f"{name}-{self.count[name]}"
        return key, f"{self.folder}/{key}"

    def drop(self) -> None:
        delete_path(self.spark, self.folder)


_stages: ContextVar[Stages | None] = ContextVar("stages", default=None)


@contextmanager
def stages_of(stages: Stages) -> Iterator[Stages]:
    """Stages written inside belong to ``stages``."""
    token = _stages.set(stages)
    try:
        yield stages
    finally:
        _stages.reset(token)


def materialise(df: DataFrame, name: str = "stage", ledger=None) -> DataFrame:
    """Write a stage once as Parquet into the session's shared checkpoint folder and read it again.

    Cuts the lineage; a later read prunes columns and knows the stage's size,
    so the planner broadcasts a small one by itself.  Inside a run
    (:func:`stages_of`) the stage goes with the run, and one that an earlier
    attempt of the run has finished is read, not written again.  ``ledger``
    (:class:`shopshift.operators.ledger.Ledger`) gets the counts of the joins
    below, which are kept with the stage.
    """
    spark, stages = df.sparkSession, _stages.get()
    if stages is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{uuid.uuid4().hex}"
        df.write.parquet(path)
        if ledger is not None:
            ledger.take()
    else:
        key, path = stages.path(name)
        note = stages.journal.finished("stage", key) if stages.journal is not None else None
        if note is None:
            df.write.mode("overwrite").parquet(path)
            note = {"path": path, "ledger": [astuple(e) for e in ledger.take()] if ledger is not None else []}
            if stages.journal is not None:
                stages.journal.finish("stage", key, note)
        elif ledger is not None:
            ledger.restore(note["ledger"])
    return spark.read.schema(df.schema).parquet(path)
