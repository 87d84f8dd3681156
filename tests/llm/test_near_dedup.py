"""Near duplicates by signature coordinates against all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from shopshift.llm import near_dedup as N
from tests.llm.helpers import SF


def plain_words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def plain_set(text, n=5):
    w = plain_words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def plain(docs, percent=85):
    """[(doc_id, n_shingles, component_id, kept)], sorted."""
    sets = [plain_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = {}
    for j, s in enumerate(sets):
        both = {}
        for g in s:
            for i in held.setdefault(g, []):
                both[i] = both.get(i, 0) + 1
            held[g].append(j)
        for i, k in both.items():
            if 100 * k >= percent * (len(s) + len(sets[i]) - k):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        c = find(i)
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def got(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_sets_match_a_plain_split():
    texts = ["", "a", " Ab\tab  c-d_e\x0bx ", "É été «oui» —", "x" * 70_000 + " y", "\n", "one two three four", "one two three four five six one two three four five", "a\x00b  c d"]
    sets = N.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    own, seen = N.spaced_words(texts), {}
    assert len(own.hash) == sum(len(plain_words(t)) for t in texts)
    for w, h in zip((w for t in texts for w in plain_words(t)), own.hash.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    least, signer = N.matches(0.85), N.Signatures(N.COORDINATES)
    agree = []
    for _ in range(400):
        x = rng.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = x[:370], np.concatenate([x[30:400]])  # 340 of 400
        agree.append(int((signer.of(a) == signer.of(b)).sum()))
    assert abs(np.mean(agree) / N.COORDINATES - 0.85) < 0.01 and min(agree) >= least
    assert 30 < least < 0.85 * N.COORDINATES


def test_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(N.dedup(docs)) == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_family_beyond_the_pivots(spark):
    rng, base = random.Random(4), [f"w{i}" for i in range(200)]
    docs = []
    for k in range(260):  # copies of one text whose pairs lie on both sides of the similarity
        own = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5, 9])):
            own[rng.randrange(200)] = f"x{rng.random()}"
        docs.append((rng.randrange(10**6), " ".join(own)))
    shared = " ".join(f"p{i}" for i in range(60))
    docs += [(2_000_000 + k, shared + " " + " ".join(f"q{k}_{i}" for i in range(60))) for k in range(120)]  # a common passage
    docs += [(3_000_000 + k, "the same few words again and again") for k in range(90)]
    want = plain(docs)
    assert len({c for _, _, c, _ in want}) > 130
    assert got(N.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))) == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "two words"), (5, "Two  WORDS"), (5, "Two  WORDS"), (6, "two, words"), (None, "null id text"), (None, "NULL id text"), (7, "z " * 100_000), (8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("mine")).withColumn("salt", F.lit(0)).withColumn("kept", F.lit(0))
    want = [(d, n, c, d == c) for d, n, c in [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, None), (None, 1, None), (7, 1, 7), (8, 1, 8)]]
    assert got(N.dedup(docs)) == sorted(want, key=str) == plain(rows)
    assert got(N.dedup(docs.limit(0))) == []
