"""Exact top-k search against all scores."""

import math

import numpy as np
import pytest

from shopshift.llm import topk as T


def brute(rows, queries, k):
    out = []
    for q, qv in queries:
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in rows if i != q and len(v) == len(qv))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,scale", [(5, 3), (40, 1000), (70, 2**28)])
def test_against_all_scores(spark, dims, scale):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.integers(-scale, scale + 1, dims).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]  # equal vectors: ties
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    queries = df.filter("id % 25 = 0")
    got = sorted(tuple(r) for r in T.top_k(df, queries, 10).collect())
    assert got == brute(rows, [r for r in rows if r[0] % 25 == 0], 10)


def test_quantise_and_unusable_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [0.5, -0.25]), (1, [0.0004, -0.0004]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = T.quantise(df, "vec_id", "embedding")
    assert {r.id: r.vec for r in v.collect()} == {0: [512, -256], 1: [0, -1], 6: [1024]}
    assert [tuple(r) for r in T.top_k(v, v.filter("id = 0")).collect()] == [(0, 1, 1, 256)]


def test_blocks_of_queries_and_empty_inputs(spark, monkeypatch):
    monkeypatch.setattr(T, "QUERY_BLOCK_BYTES", 64)
    rows = [(i, [i % 7, i % 5, -i]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    queries = df.filter("id % 10 = 0")
    assert sorted(tuple(r) for r in T.top_k(df, queries.union(queries), 3).collect()) == brute(rows, [r for r in rows if r[0] % 10 == 0], 3)
    assert T.top_k(df.limit(0), queries).count() == 0 and T.top_k(df, queries.limit(0)).count() == 0
