"""Benchmark decontamination against a search for every item in every document."""

from pyspark.sql import functions as F

from shopshift.llm import decontam as D
from tests.llm.helpers import SF, contained

ITEMS = [
    (0, "The train to Paris leaves with 5 cars and 2 engines, so how many cars does Tom see when it is 3 km away from him"),
    (1, "short one here"), (2, None), (3, ""), (4, "12 34 56"), (5, "a b"),
    (6, "We ask whether Anna gives 4 pens to Bob while Anna keeps every other pen that she has at home"),
]


def test_verbatim_items_of_the_test_table(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = contained([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = {(r.doc_id, r.item_id) for r in D.contained(docs, items).collect()}
    assert want and got == want
    kept = {r.doc_id for r in D.decontaminate(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {i for i, _ in want}


def test_reparameterised_questions_and_slots(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (10, "Intro. The train to Rome leaves with 17 cars and 1,204.5 engines, so how many cars does Jim Beam see when it is 9 miles away from him. End"),
            (11, "We ask whether Mary gives 7 pens to Jim while Mary keeps every other pen that she has at home"),
            (12, "We ask whether Mary gives 7 pens to Jim while Lucy keeps every other pen that she has at home"),
            (13, "x *** SHORT!! ONE!! HERE y"), (14, None), (15, ""), (None, "short one here"), (16, "12 34 56 78"), (17, "the train leaves"),
        ],
        "doc_id long, text string",
    ).withColumn("row_key", F.lit("mine"))
    got = {(r.doc_id, r.item_id): r for r in D.contained(docs, items).collect()}
    assert set(got) == {(10, 0), (11, 6), (13, 1), (None, 1)}  # 12: Anna cannot be Mary and Lucy
    assert got[(11, 6)].n_slots == 3
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [12, 14, 15, 16, 17]


def test_empty_repeated_and_long(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, "short one here"), (1, "short one here"), (2, "pad " * 300_000 + "short one here")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.contained(docs, items).collect()) == [(1, 1), (2, 1)]
    assert D.decontaminate(docs, items).count() == 0
    assert D.contained(docs, items.limit(0)).count() == 0 and D.decontaminate(docs, items.limit(0)).count() == 3
    assert D.contained(docs.limit(0), items).count() == 0
    # each of repeated items is found
    twice = items.filter("item_id = 1").unionByName(items.filter("item_id = 1").withColumn("item_id", F.lit(77).cast("long")))
    assert {r.item_id for r in D.contained(docs, twice).collect()} == {1, 77}


def _found(spark, items, docs):
    own = [spark.createDataFrame(list(enumerate(x)), f"{name}_id long, text string") for name, x in (("item", items), ("doc", docs))]
    return sorted((r.doc_id, r.item_id) for r in D.contained(own[1], own[0]).collect())


def test_short_items_and_items_of_placeholders(spark):
    items = ["12 + 34 * 56 - 7 = ?", "The Great Gatsby By Francis Scott Key Fitzgerald", "What is 23 + 45?", "Who wrote Hamlet?", "yes"]
    docs = [
        "so 12 + 34 * 56 - 7 = 1909", "read The Great Gatsby By Francis Scott Key Fitzgerald today", "Ask: what is 23 + 45? 68", "who WROTE hamlet?", "Yes!",
        "well, what is 5 to you", "who wrote Faust and when", "so 12 + 34 * 56 - 8 = 1908", "yesterday",
    ]
    assert _found(spark, items, docs) == [(i, i) for i in range(5)]


LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(59))


def test_long_runs_and_other_capitals(spark):
    names = "We met Anna when old Bob and his dog saw Carl run by as Dora sat near Emil who had lost a hat"
    short = "Every summer my aunt buys 12 red apples"
    items = [LONG, names, short]
    part = LONG.split()
    docs = [
        "pad " + " ".join(part[10:35]) + " end", "pad " + " ".join(part[10:22]) + " end", names.lower(), "NOTE: " + names.upper(), "Note " + names,
        "note Every summer my aunt buys 15 red apples", names.lower().replace("hat", "cap"),
    ]
    assert _found(spark, items, docs) == [(0, 0), (2, 1), (3, 1), (4, 1), (5, 2), (6, 1)]
