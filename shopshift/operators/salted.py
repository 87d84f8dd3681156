"""Joins of two sides that are both hot at the same keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of its side's rows on; there can be no more than 1 / share.
HEAVY_SHARE = 0.02
SALTS = 32


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys that hold at least about ``share`` of the rows: at most ``2 / share`` values, from a sketch of bounded size.

    The sketch's counts may be too high, never too low: no heavy key is missed.
    """
    tracked = 1 << max(7, int(20 / share).bit_length())
    top = F.call_function("approx_top_k", F.col(key), F.lit(int(2 / share)), F.lit(tracked))
    found = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] >= share * found["n"]]


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = HEAVY_SHARE, salts: int = SALTS) -> DataFrame:
    """``left.join(right, key, how)``, inner or left, with the heavy keys of ``left`` split over ``salts`` tasks.

    AQE splits one side of a skewed join; where it cannot (rows after an
    aggregate, or both sides hot) a key stays in one task.  Here the left rows
    of a heavy key are dealt by a hash of the whole row, and its right rows are
    repeated for each salt; all others are joined as they are.  Exact whatever
    keys are taken as heavy: each left row meets all right rows of its key.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is an inner or a left join")
    heavy = heavy_keys(left, key, share)
    if not heavy:
        return left.join(right, key, how)
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    dealt = left.withColumn("__salt", F.when(hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(0).cast("int"))
    repeated = right.withColumn("__salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(repeated, [key, "__salt"], how).drop("__salt")
