"""What joins keep, drop and multiply, counted while their result is written: no second scan.

An inner lookup drops rows whose code does not map, a second match multiplies
a row; neither is seen in the result.  A ledger counts both by observing the
plan: each join is planned as a left join with a marker of a match, rows without
one are counted and then filtered away.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "step string, rows_in long, rows_out long, dropped long, multiplied long"


@dataclass(frozen=True)
class Entry:
    """A join: rows of the left side, of the result, left rows without a match, and rows that further matches add."""

    step: str
    rows_in: int
    rows_out: int
    dropped: int
    multiplied: int


class Ledger:
    """Entries of the joins of a run.

    A join's counts are there once its result was written, by one action;
    ``take`` after that.  They are exact unless Spark had to run a lost map
    stage again, or read a join's rows twice (to sample them for a range
    partitioning): observe joins below a plain write.
    """

    def __init__(self) -> None:
        self.entries: list[Entry] = []
        self._open: list[tuple[str, str, Observation, Observation]] = []

    def join(self, step: str, left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
        """``left.join(right, on, how)`` for an inner or a left join; a left join's unmatched rows count as dropped by the right side, and stay."""
        if how not in ("inner", "left"):
            raise ValueError("a ledger counts inner and left joins")
        before, after, found = Observation(), Observation(), f"__match{len(self.entries) + len(self._open)}"
        left = left.observe(before, F.count(F.lit(1)).alias("n"))
        joined = left.join(right.withColumn(found, F.lit(True)), on, "left")
        joined = joined.observe(after, F.count(F.lit(1)).alias("n"), F.count_if(F.col(found).isNull()).alias("missed"))
        self._open.append((step, how, before, after))
        return (joined.filter(F.col(found)) if how == "inner" else joined).drop(found)

    def take(self) -> list[Entry]:
        """The entries of the joins since the last call; their results were written."""
        new = []
        for step, how, before, after in self._open:
            rows_in, rows_out, missed = before.get["n"], after.get["n"], after.get["missed"]
            new.append(Entry(step, rows_in, rows_out - (missed if how == "inner" else 0), missed, rows_out - rows_in))
        self._open = []
        self.entries += new
        return new

    def restore(self, entries: list[list]) -> None:
        """Entries of joins whose result an earlier attempt has written; the plan made for them now is not run."""
        self._open = []
        self.entries += [Entry(*e) for e in entries]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([astuple(e) for e in self.entries], LEDGER_SCHEMA)


def counted_join(
    ledger: Ledger | None, step: str, left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner"
) -> DataFrame:
    """A join, with an entry in ``ledger`` if there is one."""
    return left.join(right, on, how) if ledger is None else ledger.join(step, left, right, on, how)
