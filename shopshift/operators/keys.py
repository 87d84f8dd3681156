"""Surrogate keys: dense, gap-free ids in a declared order, without a single-partition window.

``row_number() over (order by ...)`` moves every row into one task.  Here the
rows are range-partitioned and sorted inside each partition (a distributed
sort), the sorted stage is written so the partition assignment is fixed,
rows are counted per partition (one small aggregate), and each partition's
offset is added to the row position inside the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopshift.sources.tables import materialise

_PID = "__key_part"
_MID = "__key_mono"


def assign_keys(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    start: int = 1,
    key_col: str = "entity_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """K5: add ``key_col`` = ``start + row_number() over (order by order_cols) - 1``.

    ``order_cols`` must order rows uniquely (add the natural key as the last
    column); otherwise ties are numbered in an arbitrary but fixed order.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = materialise(
        ordered.select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
    )
    # one row per non-empty partition: bounded by the partition count, not the data
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).orderBy(_PID).collect()
    offsets, running = [], start
    for row in counts:
        offsets.append((row[_PID], running))
        running += row["n"]
    offset_df = F.broadcast(spark.createDataFrame(offsets or [(0, start)], f"{_PID} int, __key_base long"))
    pos_in_part = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (
        tagged.join(offset_df, _PID, "inner")
        .withColumn(key_col, F.col("__key_base") + pos_in_part)
        .drop(_PID, _MID, "__key_base")
    )


def last_key(df: DataFrame, key_col: str) -> int | None:
    """K6: the largest key present (the id of the row created last); one row to the driver."""
    return df.agg(F.max(key_col).alias("m")).head()["m"]


def next_key(df: DataFrame, key_col: str) -> int:
    """The next free key after the existing ones (auto-increment continuation)."""
    m = last_key(df, key_col)
    return 1 if m is None else int(m) + 1
