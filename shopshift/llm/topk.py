"""Exact top-k inner-product search by columnar branch and bound.

Candidates are held dimension by dimension (vertical layout).  Scores are
accumulated one block of dimensions at a time; after each block a candidate
whose accumulated score plus the largest value that the remaining dimensions
can still add (the product of the remaining norms) cannot reach the k-th best
score is dropped, and the survivors are compacted.  Integer scores are exact
(beyond the range of long they are set to its ends).

Spark deals the candidates; the queries come in blocks whose bytes are bounded
(``QUERY_BLOCK_BYTES``), one pass over the candidates for each block, and a
task returns its k best per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopshift.llm.common import stage

#: Bytes of query vectors held by a task at a time.
QUERY_BLOCK_BYTES = 4 << 20
#: Dimensions accumulated between two prunings.
DIM_BLOCK = 16
LONG_MAX = 2**63 - 1


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, vec): floor(scale * x) of every component as long.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    x = F.col(vector_col)
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    )
    vec = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return vectors.filter(F.col(id_col).isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("id"), vec.alias("vec")
    )


def _layout(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertical copy of the rows ``x`` and, for each block start, the norms of what follows."""
    d = x.shape[1]
    cols = np.ascontiguousarray(x.T)
    square = cols.astype(np.float64) ** 2
    rest = [np.sqrt(square[s:].sum(axis=0)) for s in range(DIM_BLOCK, d + DIM_BLOCK, DIM_BLOCK)] if d else []
    return cols, np.array(rest).reshape(len(rest), x.shape[0])


def search_batch(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
    best: list[tuple[np.ndarray, np.ndarray]],
) -> None:
    """Merge the rows ``x`` into ``best``: per query, its k best (scores, ids), ties to smaller ids."""
    if not len(ids) or not len(q_ids):
        return
    d = q.shape[1]
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(d, 1)
    exact = np.float64 if top < 2.0**52 else np.int64 if top < 2.0**62 else object
    q, (cols, rest) = q.astype(exact), _layout(x)
    cols = cols.astype(exact)
    starts = range(0, d, DIM_BLOCK)
    q_rest = [np.sqrt((q[:, s + DIM_BLOCK :].astype(np.float64) ** 2).sum(axis=1)) for s in starts]
    first = q[:, :DIM_BLOCK] @ cols[:DIM_BLOCK] if d else np.zeros((len(q_ids), len(ids)))
    for i, own in enumerate(q_ids):
        keep = np.flatnonzero(ids != own)
        acc = first[i, keep]
        known = best[i][0]
        floor = float(known[-1]) if len(known) == k else -np.inf
        for b, s in enumerate(starts):
            if b:
                acc = acc + q[i, s : s + DIM_BLOCK] @ cols[s : s + DIM_BLOCK, keep]
            slack = q_rest[b][i] * rest[b][keep] * (1 + 1e-9) + 0.5 + 1e-15 * top  # never below the true bound
            partial = acc.astype(np.float64)
            if len(keep) > k:
                floor = max(floor, float(np.partition(partial - slack, len(keep) - k)[len(keep) - k]))
            alive = partial + slack >= floor
            if not alive.all():
                keep, acc = keep[alive], acc[alive]
        scores = np.concatenate([known, acc.astype(known.dtype if exact is not object else object)])
        names = np.concatenate([best[i][1], ids[keep]])
        if scores.dtype == object:
            scores = np.array([max(-LONG_MAX, min(LONG_MAX, v)) for v in scores], np.int64)
        order = np.lexsort((names, -scores))[:k]
        best[i] = (scores[order], names[order])


def _searcher(queries, k: int):
    """``queries`` is a broadcast block of (id, key, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, list[tuple[int, int, list[int]]]] = {}
        for row in queries.value:
            by_dim.setdefault(len(row[2]), []).append(row)
        held = {
            d: (
                np.array([r[0] for r in rows], np.int64),
                np.array([r[1] for r in rows], np.int64),
                np.array([r[2] for r in rows], np.int64).reshape(len(rows), d),
                [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in rows],
            )
            for d, rows in by_dim.items()
        }
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vec = batch.column(1)
            size = np.diff(vec.offsets.to_numpy())
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            begin = vec.offsets.to_numpy()[:-1] - vec.offsets.to_numpy()[0]
            for d, (q_ids, _, q, best) in held.items():
                rows = np.flatnonzero(size == d)
                x = flat[begin[rows][:, None] + np.arange(d)[None, :]]
                search_batch(q_ids, q, ids[rows], x, k, best)
        out = [
            (int(q_ids[i]), int(keys[i]), int(n), int(s))
            for q_ids, keys, _, best in held.values()
            for i in range(len(q_ids))
            for s, n in zip(*best[i], strict=True)
        ]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "query_key", "vec_id", "score"]
            )

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best candidates of every query by integer inner product.

    Both frames have (id long, vec array<long>), as :func:`quantise` makes
    them.  A query's own id is no candidate; candidates of another length than
    the query's are left out; all are returned if fewer than ``k``.  Ties go to
    the smaller id.  A repeated query row counts once; a repeated candidate row
    counts as often as it stands there.  Empty inputs give no rows.

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = candidates.sparkSession
    keyed = queries.select("id", F.xxhash64("vec").alias("key"), "vec").dropDuplicates(["id", "key"])
    n, width = keyed.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    blocks = -(-n * max(width, 1) * 8 // QUERY_BLOCK_BYTES)
    schema = "query_id long, query_key long, vec_id long, score long"
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    found = []
    for b in range(blocks):  # one block at the driver at a time, sent to the tasks of one pass
        rows = [tuple(r) for r in keyed.filter(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(blocks)) == b).collect()]
        sent = spark.sparkContext.broadcast(rows)
        best = candidates.select("id", "vec").mapInArrow(_searcher(sent, k), schema).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(stage(best.select("query_id", "rank", "vec_id", "score"), "best"))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionAll, found)
