"""Column helpers on hand-made edge cases (text rules of the legacy shop)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopshift.functions import columns as X
from shopshift.functions import predicates as P


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_split_full_name(spark):
    first, last = X.split_full_name("n")
    got = one(spark, "n string", [("John Smith",), ("Cher",), ("A B C",), (None,), ("",)], first, last)
    assert got == [("John", "Smith"), ("", "Cher"), ("A", "B C"), (None, None), ("", "")]


def test_name_fallback_keeps_customer_names(spark):
    f, l = X.name_with_fallback("cf", "cl", "full")
    got = one(spark, "cf string, cl string, full string", [("Ann", None, "Jo Doe"), (None, None, "Jo Doe")], f, l)
    assert got == [("Ann", "Doe"), ("Jo", "Doe")]


def test_street_lines(spark):
    got = one(spark, "a string, b string", [("1 Main", ""), ("1 Main", None), ("1 Main", "Sub")], X.street_lines("a", "b"))
    assert got == [("1 Main",), ("1 Main",), ("1 Main\nSub",)]


def test_mask_strip_only_upper_case(spark):
    got = one(spark, "c string", [("XXXXXXXXXXXX1234",), ("xxxx1234",), ("",)], X.mask_strip("c"))
    assert got == [("1234",), ("xxxx1234",), ("",)]


def test_expiry_parts(spark):
    m, y = X.expiry_parts("e")
    got = one(spark, "e string", [("0314",), ("03",), ("",), (None,)], m, y)
    assert got == [("03", "2014"), ("03", None), (None, None), (None, None)]


@pytest.mark.parametrize(
    "comment,gate,kind,amount",
    [
        ("x; $12.50)", True, "CHARGE", Decimal("12.50")),
        ("x; $-6.55)", True, "REFUND", Decimal("-6.55")),
        ("(a) x; $1.00)", True, "CHARGE", None),  # first ')' precedes the '; '
        ("a; b; $2.00)", True, "CHARGE", None),  # first '; ' is not the amount's
        ("x; $1,234.50)", False, None, None),
        ("x; $7)", False, None, None),
        ("line one\nx; $3.00)", True, "CHARGE", Decimal("3.00")),
        ("", False, None, None),
        (None, None, None, None),
    ],
)
def test_comment_amount(spark, comment, gate, kind, amount):
    k, a = X.comment_amount("c")
    g = X.carries_amount("c")
    row = spark.createDataFrame([(comment,)], "c string").select(
        g.alias("g"), F.when(g, k).alias("k"), F.when(g, a).alias("a")
    ).head()
    assert (row["g"], row["k"], row["a"]) == (gate, kind, amount)


def test_skus(spark):
    got = one(
        spark,
        "t string, n string, o string, v string",
        [("bulbs", "H1 Kit", "Colour", "Dark Red"), (None, "Kit", None, "x")],
        X.legacy_sku("t", "n", "FLAG"),
        X.option_sku("o", "v"),
    )
    assert got == [("bulbs-H1 Kit-FLAG", "Legacy-Colour-Dark-Red"), ("Kit-FLAG", "Legacy-x")]


@pytest.mark.parametrize("opt,oid", [("Colour", 7), ("Größe", 12345), ("", 1)])
def test_serialized_option_length_prefix(spark, opt, oid):
    got = spark.createDataFrame([(opt, oid)], "o string, i long").select(X.serialized_option("o", "i")).head()[0]
    n_opt, n_id = len(opt), len(str(oid))
    inner = (
        f'a:4:{{s:5:"price";d:0;s:3:"qty";d:1;s:12:"option_label";s:{n_opt}:"{opt}";'
        f's:9:"option_id";s:{n_id}:"{oid}";}}'
    )
    assert got == f'a:2:{{s:15:"info_buyRequest";a:0:{{}}s:27:"bundle_selection_attributes";s:{len(inner)}:"{inner}";}}'


def test_serialized_option_null_option_is_null(spark):
    assert spark.createDataFrame([(None, 3)], "o string, i long").select(X.serialized_option("o", "i")).head()[0] is None


def test_rating_percent_and_int_div(spark):
    got = one(spark, "r int", [(1,), (3,), (5,), (-7,)], X.rating_percent("r"), X.int_div(F.col("r"), 2))
    assert got == [(20, 0), (60, 1), (100, 2), (-140, -3)]


def test_shipping_total(spark):
    s = "s decimal(12,4), i decimal(12,4), g decimal(12,4)"
    rows = [(Decimal("5"), None, Decimal("1.5")), (None, Decimal("1"), Decimal("1")), (Decimal("2"), None, None)]
    got = one(spark, s, rows, X.shipping_total("s", "i", "g"))
    assert got == [(Decimal("6.5000"),), (None,), (Decimal("2.0000"),)]


def test_path_parent(spark):
    rows = [("a/b/c.jpg",), ("b/c.jpg",), ("c.jpg",), ("",), (None,)]
    assert one(spark, "p string", rows, X.path_parent("p")) == [("b",), ("b",), ("c.jpg",), ("",), (None,)]


def test_predicates(spark):
    df = spark.createDataFrame([("a-FLAG", 78), ("", 79), (None, None), ("x%FLAG", 1)], "s string, z int")
    assert df.filter(P.present("s")).count() == 2
    assert df.filter(P.at_most("z", 78)).count() == 2
    assert df.filter(P.ends_with("s", "FLAG")).count() == 2
    assert df.filter(P.ends_with("s", "%FLAG")).count() == 1
    assert df.filter(P.differs("s", "")).count() == 2


def test_strict_concat_propagates_null(spark):
    got = one(spark, "a string, n int", [("x", 20), (None, 20), ("y", None)], X.strict_concat(F.col("a"), F.col("n")))
    assert got == [("x20",), (None,), (None,)]
    assert one(spark, "a string", [("03",)], X.strict_concat(F.lit("20"), F.col("a"))) == [("2003",)]
