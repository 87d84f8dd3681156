"""Ranked lexical search against a plain ranking."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from shopshift.llm import lexical as L
from tests.llm.helpers import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    own = [(d, Counter(plain_terms(t))) for d, t in docs]
    n = sum(bool(c) for _, c in own)
    length = sum(sum(c.values()) for _, c in own)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(plain_terms(t))
    out = []
    for i, ts in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c in own) + 1))) for t in ts}
        scored = []
        for d, c in own:
            m = 10 + 90 * sum(c.values()) * n // length if length else 0
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_terms_match_the_expression():
    for t in [None, "", " .-", "Ab c9-D_e", "ÉTÉ été Straße", "a\x00b\x7fc\x80d", "İ ſ K", "x" * 100_000, "`[{@/:"]:
        assert [x.decode() for x in L.terms(t)] == plain_terms(t)


def test_test_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(L.search(docs, items)) == want
    # blocks of items give the same, whatever their size
    assert got(L.search(docs, items, block_terms=60)) == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "?!"), (4, "Red fox"), (5, "red fox"), (5, "red fox"), (None, "red fox"), (6, "fox " * 50_000 + "blue"), (7, "été"), (8, "grey sky")]
    wanted = [(1, "RED"), (2, None), (3, "..."), (4, "fox blue fox"), (None, "Été été"), (1, "sky"), (9, "absent")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("term", F.lit(1))
    items = spark.createDataFrame(wanted, "item_id long, text string").withColumn("rank", F.lit(0))
    assert got(L.search(docs, items)) == plain(rows, wanted)
    assert got(L.search(docs, items, top=2)) == plain(rows, wanted, 2)
    assert got(L.search(docs.limit(0), items)) == [] and got(L.search(docs, items.limit(0))) == []
    assert got(L.search(docs.filter("doc_id < 4"), items)) == []


def test_ties_beyond_the_heap(spark):
    rows = [(i, "one two") for i in range(400, 0, -1)] + [(1000, "three four")]
    items = [(1, "two"), (2, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(L.search(docs, spark.createDataFrame(items, "item_id long, text string"))) == plain(rows, items)
