"""Packing: ids as the tokenizer gives them, gapless sequences, few of them."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopshift.llm import packing as P
from tests.llm.helpers import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_the_test_documents(spark, reference):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tok = P.ByteLevelTokenizer(PATH)
    for part in (texts, texts[::-1]):  # the second time from what is known
        assert [x.tolist() for x in tok.encode(part)] == reference(part)
    tok.used = P.CACHE_TOKENS + 1  # forgets and starts anew
    assert [x.tolist() for x in tok.encode(texts[:20])] == reference(texts[:20])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t \u0085 　\x1c\x1fabé日ÀЖ'1.<|>"), max_size=30), max_size=6))
def test_ids_of_odd_texts(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    assert [x.tolist() for x in P.tokenizer(PATH).encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pack_of_the_test_documents(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    rows = docs.collect()
    for r, ids in zip(rows, reference([r.text or "" for r in rows]), strict=True):
        ids = [*ids, 0]
        head = len(ids) % 2048 if len(ids) > 2048 else len(ids)
        cuts = ([(0, head)] if head else []) + [(s, 2048) for s in range(head, len(ids), 2048)]
        for i, (s, n) in enumerate(cuts):
            want[(r.doc_id, i)] = (s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))
    got = P.pack(docs, PATH).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    check_sequences(got, 2048)
    assert len({r.sequence_id for r in got}) == -(-sum(r.length for r in got) // 2048)


def check_sequences(rows, capacity):
    own = {}
    for r in rows:
        own.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in own.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_edges_and_sequences(spark, reference):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "hello world " * 3000), (None, "x"), (4, "same"), (4, "same")], "doc_id long, text string")
    got = P.pack(docs, PATH, 64, 0, keep_ids=True)
    rows = got.collect()
    check_sequences(rows, 64)
    assert sorted(r.length for r in rows if r.doc_id in (1, 2)) == [1, 1] and len([r for r in rows if r.doc_id == 4]) == 2
    assert [r.piece for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 3] == list(range(len([r for r in rows if r.doc_id == 3])))
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    whole = P.sequences(got).collect()
    assert sum(len(r.ids) // 4 for r in whole) == sum(r.length for r in rows) and len(whole) == len({r.sequence_id for r in rows})
    assert P.pack(docs.limit(0), PATH).count() == 0


def brute_best(lengths, room):
    best = 0
    for mask in range(1 << len(lengths)):
        s = sum(x for i, x in enumerate(lengths) if mask >> i & 1)
        best = max(best, s if s <= room else 0)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_plans_are_whole_and_completion_is_best(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(1, 100) for _ in range(60))
    items = sorted(rng.choices(list(counts), k=9))
    some = Counter(items)
    assert sum(P.completion(sorted(some), some, 100)) == brute_best(items, 100)
    lower = -(-sum(k * n for k, n in counts.items()) // 100)
    for plan in (P.best_fit(counts, 100), P.complete_bins(counts, 100), P.plan(counts, 100)):
        used = Counter()
        for times, kind in plan:
            assert sum(kind) <= 100 and times > 0
            for k in kind:
                used[k] += times
        assert used == counts and sum(t for t, _ in plan) >= lower
    assert sum(t for t, _ in P.plan(counts, 100)) <= sum(t for t, _ in P.best_fit(counts, 100))


def test_completion_beats_best_fit_somewhere():
    # best-fit decreasing needs five sequences of 100 here
    counts = Counter([57, 41, 2, 57, 41, 2, 50, 26, 24, 50, 25, 25])
    assert sum(t for t, _ in P.plan(counts, 100)) == 4


def test_a_hot_length_is_numbered_in_parts(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(3000)], "doc_id long, text string")
    rows = P.pack(docs, PATH, 100).collect()
    check_sequences(rows, 100)
    n = rows[0].length
    assert len({r.sequence_id for r in rows}) == -(-3000 // (100 // n))


@pytest.mark.parametrize("times", [1, 1000])
def test_search_goes_past_greedy_completion(times):
    # best-fit decreasing and the greedy completion need four sequences of 100 here
    counts = {k: n * times for k, n in Counter([44, 40, 38, 35, 31, 31, 30, 26, 25]).items()}
    found = P.plan(counts, 100)
    used = Counter()
    for t, kind in found:
        assert sum(kind) <= 100
        for k in kind:
            used[k] += t
    assert used == counts and sum(t for t, _ in found) == 3 * times


def fewest(items, capacity):
    best = [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                put(i + 1, [*bins[:j], bins[j] + items[i], *bins[j + 1 :]])
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best[0]


def test_plans_are_optimal():
    rng = random.Random(5)
    for case in range(300):
        items = sorted((rng.randint(*[(1, 60), (20, 50), (10, 35), (1, 12)][case % 4]) for _ in range(rng.randint(1, 11))), reverse=True)
        capacity = 60 if case % 4 < 3 else 17
        assert sum(t for t, _ in P.plan(Counter(items), capacity)) == fewest(items, capacity), items


def test_what_a_worker_holds_is_bounded():
    """New words without end are forgotten, and arrays beside a chunk of text stay small."""
    tok = P.ByteLevelTokenizer(PATH)
    most = 0
    tracemalloc.start()
    for i in range(0, 600_000, 20_000):
        tok.encode([" ".join(f"w{j * 7919 % 10**7}" for j in range(s, s + 500)) for s in range(i, i + 20_000, 500)])
        most = max(most, tok.used)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most <= P.CACHE_TOKENS + P.CHUNK_BYTES < 1_500_000 and peak < 70e6, (most, peak)
