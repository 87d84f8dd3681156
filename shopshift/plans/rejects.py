"""Rows of the legacy tables that a run sets aside, with reasons, in one table (``migration_rejects``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import columns as X
from shopshift.operators.rejects import REASONS, split_rejects, too_long

#: Characters that a name, SKU or comment column of the target holds.
SHORT_TEXT = 255


def as_records(rejects: DataFrame, source: str, key: str) -> DataFrame:
    """Rejects of one table in the form of the common one; ``detail`` is the whole row as JSON, so nothing of it is lost."""
    own = [c for c in rejects.columns if c != REASONS]
    return rejects.select(
        F.lit(source).alias("source"), F.col(key).cast("string").alias("row_key"), F.array_join(REASONS, ",").alias("reasons"),
        F.to_json(F.struct(*own)).alias("detail"),
    )


def split_orders(src: dict[str, DataFrame], cfg: MigrationConfig) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables without rejects, rejects) of the order tables.

    Set aside are totals of a class that the order has twice, history rows
    whose comment carries an amount that cannot be read, and order lines whose
    name or model is longer than its target column.
    """
    totals = src["orders_total"]
    wanted = F.col("class").isin(list(C.ORDER_TOTAL_CLASSES))
    good, twice = split_rejects(totals.filter(wanted), {}, {"repeated class": ["orders_id", "class"]})
    amount = X.comment_amount("comments", "decimal(12,2)")[1]
    history, unread = split_rejects(src["orders_status_history"], {"unreadable amount": X.carries_amount("comments") & amount.isNull()})
    lines, long = split_rejects(
        src["orders_products"], {"long name": too_long("products_name", SHORT_TEXT), "long model": too_long("products_model", SHORT_TEXT)}
    )
    rejects = [
        as_records(twice, "orders_total", "orders_id"),
        as_records(unread, "orders_status_history", "orders_status_history_id"),
        as_records(long, "orders_products", "orders_products_id"),
    ]
    kept = {"orders_total": good, "orders_status_history": history, "orders_products": lines}
    return {**src, **kept}, reduce(DataFrame.unionAll, rejects)
