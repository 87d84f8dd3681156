"""Predicates (Column -> boolean Column) used as ``df.filter(pred)`` or inside join sides.

All are built-in comparisons, so Catalyst can push them into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def present(x) -> Column:
    """text that is neither NULL nor empty."""
    c = _c(x)
    return c.isNotNull() & (c != "")


def at_most(x, bound) -> Column:
    """``x <= bound``."""
    return _c(x) <= bound


def one_of(x, values: Iterable) -> Column:
    """``x in (values)``."""
    return _c(x).isin(list(values))


def equals(x, value) -> Column:
    """equality to a parameter or literal."""
    return _c(x) == (value if isinstance(value, Column) else F.lit(value))


def ends_with(x, suffix: str, literal: bool = True) -> Column:
    """``x like concat('%', suffix)``.

    With ``literal=True`` the suffix is matched verbatim (so a ``%`` or ``_`` in
    the flag is not a wildcard); otherwise LIKE semantics apply to it.
    """
    c = _c(x)
    return c.endswith(suffix) if literal else c.like("%" + suffix)


def is_missing(x) -> Column:
    """``x is null``."""
    return _c(x).isNull()


def is_known(x) -> Column:
    """``x is not null``."""
    return _c(x).isNotNull()


def differs(x, value) -> Column:
    """F8: ``x != value``; NULL on either side rejects the row."""
    return _c(x) != (value if isinstance(value, Column) else F.lit(value))


def same_value(a, b) -> Column:
    """two columns of the same row are equal."""
    return _c(a) == _c(b)
