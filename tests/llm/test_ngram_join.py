"""N-gram Jaccard join against all pairs."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopshift.llm import ngram_join as N
from shopshift.llm import words as W
from shopshift.llm.components import connected_components
from tests.llm.helpers import SF, classes, grams, word_list


def test_words_match_a_plain_split():
    texts = ["", "a", "Ab  c-d_e", "É été «oui» — non…", "x" * 300 + " y", "\n", "Ж ж", "don't 1,234.5 km"]
    own = W.words(texts)
    b, seen = own.bounds(), {}
    for i, t in enumerate(texts):
        plain = word_list(t)
        assert len(plain) == b[i + 1] - b[i], t
        for w, h in zip(plain, own.hash[b[i] : b[i + 1]], strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)
    sets = N.ngram_sets(texts, 5)
    assert [len(s) for s in sets] == [len(grams(t)) for t in texts]


def test_bands_reach_the_recall():
    b = N.bands_for(0.8, 8, 0.999)
    assert 1 - (1 - 0.8**8) ** b >= 0.999 > 1 - (1 - 0.8**8) ** (b - 1)


def test_similar_counts_exactly():
    sets = [np.array(s, np.uint64) for s in ([1, 2, 3, 4], [1, 2, 3, 4, 5], [9], [2, 3, 4, 5])]
    assert N.similar(sets, np.zeros(4), 0.75).tolist() == [[0, 1], [1, 3]]
    assert N.similar(sets, np.array([0, 0, 1, 1]), 0.6).tolist() == [[0, 3], [1, 3]]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 203), (203, 201)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    parts = {}
    for i, c in got.items():
        parts.setdefault(c, set()).add(i)
    assert sorted(map(sorted, parts.values())) == [list(range(41)), [100, 101], [200, 201, 203]]


def test_classes_and_links_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.classify(docs).collect()}
    assert got == want


def test_near_copies_in_a_large_family(spark):
    base = [f"w{i}" for i in range(60)]
    docs = []
    for k in range(150):  # three blocks of near copies; neighbours differ in one word
        own = list(base)
        own[k % 60] = f"x{k}"
        docs.append((k, " ".join(own)))
    docs += [(1000 + k, "same text again and again here") for k in range(40)]
    want = classes(docs)
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.classify(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and got[1000] == (1000, 39)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n!"), (4, "two words"), (5, "Two, words"), (5, "Two, words"), (None, "null id text"), (6, "z " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit("mine")).withColumn("class_id", F.lit(0))
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in N.classify(docs.select("doc_id", "text")).collect()), key=str)
    assert got == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (5, 4, 2), (5, 4, 2), (None, None, 0), (6, 6, 0)], key=str)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, None, 6], key=str)
    assert N.classify(docs.limit(0)).count() == 0 and N.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")] * 3 + [(2, "a b c d e f g"), (3, "other words that stand alone")], "doc_id long, text string")
    assert sorted(r.doc_id for r in N.one_of_each(docs).collect()) == [1, 3]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_short_texts_are_one_gram(n):
    text = " ".join("abc"[:n])
    assert len(N.ngram_sets([text], 5)[0]) == (1 if n else 0)


def test_memory_beside_many_texts():
    """Arrays of a chunk, not of a batch: 4 MB of texts take less than 32 MB beside their sets."""
    texts = [" ".join(f"w{(i * 7919 + j) % 100_003}" for j in range(500)) for i in range(1200)]
    tracemalloc.start()
    sets = N.ngram_sets(texts, 5)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [len(s) for s in sets] == [496] * 1200 and peak - now < 32e6, peak - now
