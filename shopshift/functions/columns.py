"""Column helpers: every helper builds a built-in expression (JVM side, codegen, no UDF).

Text rules follow the legacy shop's behaviour, spelled out per helper:
NULL handling, empty strings and first-occurrence positions matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopshift.config import AMOUNT_GATE_PATTERN, CHARGE_PATTERN


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text(x) -> Column:
    """X11: a value as text (integers in decimal notation)."""
    return _c(x).cast("string")


def path_parent(path) -> Column:
    """The folder that holds the last path segment (``a/b/c.jpg`` -> ``b``).

    With no ``/`` at all the whole string is returned.
    """
    return F.substring_index(F.substring_index(_c(path), "/", -2), "/", 1)


def strict_concat(*parts) -> Column:
    """Concatenation that is NULL when any part is NULL (numbers become text)."""
    return F.concat(*[text(p) if not isinstance(p, Column) else p.cast("string") for p in parts])


def blank_to_null(x) -> Column:
    """``nullif(x, '')``."""
    return F.nullif(_c(x), F.lit(""))


def prefix_before(s, sep: str = " ") -> Column:
    """Text before the first ``sep``; ``''`` when ``sep`` is absent, NULL for NULL."""
    s = _c(s)
    return s.substr(F.lit(1), F.locate(sep, s) - 1)


def suffix_after(s, sep: str = " ") -> Column:
    """Text after the first ``sep``; the whole text when ``sep`` is absent."""
    s = _c(s)
    return s.substr(F.locate(sep, s) + len(sep), F.lit(2**31 - 1))


def split_full_name(full) -> tuple[Column, Column]:
    """H1: (first, last) of a full name split at the first space."""
    return prefix_before(full, " "), suffix_after(full, " ")


def name_with_fallback(first, last, full) -> tuple[Column, Column]:
    """H1 as used for orders: keep the customer's names, else split the order's full name."""
    f, l = split_full_name(full)
    return F.coalesce(_c(first), f), F.coalesce(_c(last), l)


def street_lines(street, suburb) -> Column:
    """H2: street and suburb on two lines; an empty or NULL suburb adds no line."""
    return F.concat_ws("\n", _c(street), blank_to_null(suburb))


def mask_strip(card) -> Column:
    """H3: remove the upper-case ``X`` mask from a card number (lower-case ``x`` stays)."""
    return F.replace(_c(card), F.lit("X"), F.lit(""))


def expiry_parts(mmyy) -> tuple[Column, Column]:
    """H4: (month, year) of an ``MMYY`` expiry; a missing part gives NULL."""
    e = _c(mmyy)
    month = blank_to_null(e.substr(1, 2))
    year = F.concat(F.lit("20"), blank_to_null(e.substr(3, 2)))
    return month, year


def carries_amount(comment) -> Column:
    """The comment holds ``; $<amount with cents>`` somewhere (regex search)."""
    return _c(comment).rlike(AMOUNT_GATE_PATTERN)


def comment_amount(comment, amount_type: str = "decimal(12,2)") -> tuple[Column, Column]:
    """H5: (transaction type, amount) parsed from a history comment.

    Type is CHARGE when the amount has no minus sign, else REFUND.  The
    amount is the text between the first ``'; '`` (plus the ``$``) and the
    first ``')'``; text that is not a number gives NULL instead of failing.
    """
    c = _c(comment)
    kind = F.when(c.rlike(CHARGE_PATTERN), F.lit("CHARGE")).otherwise(F.lit("REFUND"))
    start = F.locate("; ", c) + 3
    length = F.greatest(F.locate(")", c) - F.locate("; ", c) - 3, F.lit(0))
    amount = c.substr(start, length).try_cast(amount_type)
    return kind, amount


def legacy_sku(product_type, name, flag) -> Column:
    """H6: ``type-name-flag``, NULL parts skipped."""
    return F.concat_ws("-", _c(product_type), _c(name), flag if isinstance(flag, Column) else F.lit(flag))


def option_sku(option, value) -> Column:
    """H7: ``Legacy <option> <value>`` with every space turned into ``-``."""
    return F.replace(F.concat_ws(" ", F.lit("Legacy"), _c(option), _c(value)), F.lit(" "), F.lit("-"))


def _ser_str(s: Column) -> Column:
    """A length-prefixed string ``s:<chars>:"<text>"`` (length in characters)."""
    return F.concat(F.lit("s:"), F.char_length(s).cast("string"), F.lit(':"'), s, F.lit('"'))


def serialized_option(option, option_id) -> Column:
    """H8: the serialised bundle-selection text of one order-item option.

    The inner record carries price 0, qty 1, the option label and the option
    id; the outer record wraps it as a string, so its length prefix is the
    character length of the inner record.
    """
    label = _c(option).cast("string")
    oid = text(option_id)
    inner = F.concat(
        F.lit('a:4:{s:5:"price";d:0;s:3:"qty";d:1;s:12:"option_label";'),
        _ser_str(label),
        F.lit(';s:9:"option_id";'),
        _ser_str(oid),
        F.lit(";}"),
    )
    return F.concat(
        F.lit('a:2:{s:15:"info_buyRequest";a:0:{}s:27:"bundle_selection_attributes";'),
        _ser_str(inner),
        F.lit(";}"),
    )


def int_div(numerator, denominator) -> Column:
    """Integer division truncating toward zero (SQL ``div``), as bigint."""
    n = _c(numerator).cast("long")
    d = (denominator if isinstance(denominator, Column) else F.lit(denominator)).cast("long")
    return F.call_function("div", n, d)


def rating_percent(rating, scale_max: int = 5) -> Column:
    """H9: ``100 * rating div scale_max``."""
    return int_div(_c(rating).cast("long") * 100, scale_max)


def shipping_total(shipping, insurance, signature, result_type: str = "decimal(12,4)") -> Column:
    """Shipping plus insurance and signature (missing add-ons count 0; missing shipping stays NULL).

    The sum is cast to the target column type (``result_type``).
    """
    zero = F.lit(0).cast(result_type)
    return (_c(shipping) + F.coalesce(_c(insurance), zero) + F.coalesce(_c(signature), zero)).cast(result_type)
