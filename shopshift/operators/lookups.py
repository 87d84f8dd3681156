"""Code translation through lookup tables, and a report of what failed to map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopshift.operators.ledger import Ledger, counted_join


def _fold(c: Column) -> Column:
    return F.lower(F.rtrim(c))


def map_codes(
    df: DataFrame,
    lookup: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    fold: bool = False,
    drop_key: bool = True,
    ledger: Ledger | None = None,
    step: str = "",
) -> DataFrame:
    """Translate ``df[left_on]`` through ``lookup[right_on]``.

    With the default inner join a row whose code is unmapped (or NULL)
    disappears, as in the legacy migration; use ``unmapped_report`` to see them.
    ``lookup`` should be small and already marked for broadcast
    (``inline_lookup``).  ``fold`` compares codes
    case-insensitively and ignoring trailing blanks.  ``ledger`` counts the
    rows kept and dropped as entry ``step``.
    """
    lk = df[left_on]
    rk = lookup[right_on]
    cond = (_fold(lk) == _fold(rk)) if fold else (lk == rk)
    out = counted_join(ledger, step, df, lookup, cond, how)
    return out.drop(rk) if drop_key else out


def unmapped_report(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str, fold: bool = False) -> DataFrame:
    """Rows of ``df`` that an inner ``map_codes`` would drop (left anti join)."""
    lk = df[left_on]
    rk = lookup[right_on]
    cond = (_fold(lk) == _fold(rk)) if fold else (lk == rk)
    return df.join(lookup, cond, "left_anti")
