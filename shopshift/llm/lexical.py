"""Ranked lexical search, reversed: the items' terms are the index, the documents are streamed through it.

* An item's distinct terms are taken by Spark.  Items are cut into blocks of bounded
  size by a hash of their id; of a block, an inverted index (term -> items) is sent
  to every task.  One block is at the driver at a time, however many there are.
* A first pass over the documents counts, within tasks and then by a sum, the
  documents with a term, all their terms, and the documents that hold each term of
  the block.
* A second pass looks every document's term counts up in the index, adds the items'
  scores, and keeps a bounded heap per item.  A task returns its heaps; the heaps
  of an item are merged by a ranking that also cuts before the shuffle.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopshift.llm.common import stage

#: Highest-scoring documents of an item.
TOP = 10
#: Share of the length correction, in hundredths, and the curve's factor (score = w * tf / (tf + 0.008 m)).
LENGTH_PERCENT, CURVE = 90, 8
#: Terms of all items of a block, about.
BLOCK_TERMS = 1_000_000

#: A term is a run of ASCII letters and digits and of characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, A to Z folded to lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of all rows of an item_id; without items that have none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    each = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.array_distinct(F.split(F.translate("text", upper, upper.lower()), SEPARATORS))).alias("term"),
    )
    return each.filter("term != ''").groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


@dataclass
class Index:
    """Inverted index of a block: the items of term t are ``items[start[t] : start[t + 1]]``."""

    ids: list[int | None]
    number: dict[bytes, int]
    start: np.ndarray
    items: np.ndarray
    weight: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[int | None, list[str]]]) -> Index:
        """rows: (item_id, distinct terms)."""
        held: dict[bytes, list[int]] = {}
        for i, (_, own) in enumerate(rows):
            for t in own:
                held.setdefault(t.encode(), []).append(i)
        size = [len(v) for v in held.values()]
        return cls(
            [r[0] for r in rows], {t: i for i, t in enumerate(held)}, np.cumsum([0, *size]),
            np.array([i for v in held.values() for i in v], np.int32),
        )


def _counted(number: dict[bytes, int]):
    """(term, n) of a task: the documents that hold each term of the block; as terms -1 and -2, the documents and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(number), np.int64)
        documents = length = 0
        for batch in batches:
            for text in batch.column(0):
                own = terms(text.as_py())
                documents += bool(own)
                length += len(own)
                held[[number[t] for t in number.keys() & set(own)]] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([some, [-1, -2]]), pa.int64()), pa.array(np.concatenate([held[some], [documents, length]]), pa.int64())],
            names=["term", "n"],
        )

    return run


def weight(documents: int, holding: int) -> int:
    """The weight of a term that ``holding`` of ``documents`` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _ranked(index, documents: int, length: int, top: int):
    """(item, doc_id, score) of a task: the entries of its heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = index.value
        heaps: list[list[tuple[int, int, int | None]]] = [[] for _ in own.ids]
        floor = np.ones(len(own.ids), np.int64)  # the least score that can enter a heap
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                hits = [(own.number[t], tf) for t, tf in Counter(words).items() if t in own.number]
                if not hits:
                    continue
                m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * len(words) * documents // length
                t, tf = np.array(hits, np.int64).T
                gain = own.weight[t] * (1_000_000_000 * tf // (1000 * tf + CURVE * m))
                lists = [own.items[own.start[i] : own.start[i + 1]] for i in t]
                score = np.zeros(len(own.ids), np.int64)
                np.add.at(score, np.concatenate(lists), np.repeat(gain, [len(x) for x in lists]))
                # the smaller doc_id wins a tie, null comes last
                place = -doc_id if doc_id is not None else -(1 << 64)
                for i in np.flatnonzero(score >= floor).tolist():
                    heap, entry = heaps[i], (int(score[i]), place, doc_id)
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        floor[i] = heap[0][0]
        out = [(own.ids[i], d, s) for i, heap in enumerate(heaps) for s, _, d in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` rows of ``docs`` (doc_id, text) for each item (item_id, text).

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    folded in A to Z only, over the whole text.  A row's score is the sum, over
    the item's terms, of a weight that falls with the documents that hold the
    term, times a share that grows with its occurrences in the row and falls
    with the row's length.  Only scores above 0 are ranked; equal ones by
    ascending doc_id, null last.

    A null, empty or wordless text has no term: such a document is not found and
    counts as none, such an item has no result.  Repeated rows of ``docs`` are
    documents each and may take several ranks.  All rows of one item_id (null
    too) are one item with the terms of all of them.  No documents or no items
    give no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = stage(item_terms(items), "items")
    size = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_terms))
    found = []
    for b in range(blocks):
        rows = [(r["item_id"], r["terms"]) for r in wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()]
        if not rows:
            continue
        index = Index.of(rows)
        counted = docs.select("text").mapInArrow(_counted(index.number), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        n = {r["term"]: r["n"] for r in counted.collect()}
        documents, length = n.get(-1, 0), n.get(-2, 0)
        if not length:
            continue
        index.weight = np.array([weight(documents, n.get(i, 0)) for i in range(len(index.number))], np.int64)
        sent = spark.sparkContext.broadcast(index)
        heaps = docs.mapInArrow(_ranked(sent, documents, length, top), "item_id long, doc_id long, score long")
        place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = heaps.select("item_id", F.row_number().over(place).alias("rank"), "doc_id", "score").filter(F.col("rank") <= top)
        found.append(stage(best, "ranked"))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)
