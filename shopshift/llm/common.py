"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift.session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one use under the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Cuts the lineage: what several consumers read is computed once, and a
    lost executor costs only the tasks that ran on it.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has the name (ignoring case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def kept_columns(df: DataFrame, keep: list[str], results: list[str]) -> list[Column]:
    """The columns ``keep`` of ``df`` for a frame that adds ``results``: one whose name a result takes (ignoring case) becomes ``kept_<name>``."""
    taken = {r.lower() for r in results}
    return [F.col(f"`{c}`").alias(fresh_name(df, f"kept_{c}") if c.lower() in taken else c) for c in keep]


#: Rows of a hot key are dealt over as many tasks.
SALTS = 32


def salt(of: str) -> Column:
    """A number below ``SALTS`` from the value of column ``of``, as column ``salt``."""
    return F.pmod(F.xxhash64(F.lit(7), of), F.lit(SALTS)).cast("int").alias("salt")


def salts() -> Column:
    """Which salts a group's rows have, as the bits of one number: an aggregate that tasks make before a shuffle."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))).alias("salts")


def each_salt(df: DataFrame) -> DataFrame:
    """A row of ``df`` for each of its ``salts``, to meet the rows of a hot key in several tasks."""
    has = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.call_function("getbit", F.col("salts"), s) == 1)
    return df.withColumn("salt", F.explode(has)).drop("salts")


#: Rows that a Python task is handed at once.  Spark's own default of 10,000 whole documents would be
#: 34 MB on average and more than a gigabyte where documents are long.
ARROW_ROWS = 1000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on the executors, and batches of bounded rows.

    A batch size that the session's user has set to less stays.
    """
    ship_package(spark)
    if not 0 < int(spark.conf.get(_ARROW)) <= ARROW_ROWS:
        spark.conf.set(_ARROW, str(ARROW_ROWS))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application (needless where it is installed there)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="shopshift-code-")) / "shopshift_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
