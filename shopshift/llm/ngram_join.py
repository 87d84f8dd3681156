"""Similarity join of documents on word n-grams: MinHash bands, verified on the full sets.

* Texts with the same n-gram set are one class; everything after works on classes.
* A class has ``rows * bands`` minimum hashes; two classes that agree in all
  rows of a band meet in its bucket.  The number of bands follows from the
  similarity, the rows and the wanted recall.
* A bucket links its classes to its smallest one, never in pairs.  What hangs
  together over buckets is a family; similar classes are in one family.
* Families are sorted by set size and cut into blocks of bounded size; pairs of
  blocks whose sizes allow the similarity are compared in tasks, on the full
  n-gram sets.  A task returns a row per class: how many documents it is linked
  to, and one class it hangs together with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import fresh_name, stage
from shopshift.llm.components import connected_components
from shopshift.llm.words import chunks, mix, shingles, words

NGRAM, SIMILARITY = 5, 0.8
#: Rows of a band and the share of pairs at the similarity that must meet.
ROWS, RECALL = 8, 0.999
#: A block holds as many classes, and as many n-grams, at most (or one class).
BLOCK_CLASSES, BLOCK_NGRAMS = 64, 100_000


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """Bands of ``rows`` rows in which a pair of the similarity meets with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(similarity, 1 - 1e-9) ** rows)))


def ngram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    out: list[np.ndarray] = []
    for _, part in chunks(texts):
        own = words(part)
        h, text = shingles(own, n)
        at = np.searchsorted(text, np.arange(len(part) + 1))
        out += [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


class MinHash:
    """Band hashes of n-gram sets."""

    def __init__(self, rows: int, bands: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.rows, self.bands = rows, bands
        self.factor = (rng.integers(0, 2**31, rows * bands, dtype=np.uint32) * 2 + 1)[:, None]
        self.power = np.multiply.accumulate(np.full(rows, 0x9E3779B97F4A7C15, np.uint64))
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def band_hashes(self, own: np.ndarray) -> np.ndarray:
        """One 64-bit hash for each band (the band's number is part of it); ``own`` is not empty."""
        low = np.full(self.rows * self.bands, 2**32 - 1, np.uint32)
        x = (own >> np.uint64(32)).astype(np.uint32)
        for s in range(0, len(x), 512):
            np.minimum(low, (self.factor * x[s : s + 512]).min(axis=1), out=low)
        return mix((low.reshape(self.bands, self.rows).astype(np.uint64) * self.power).sum(axis=1, dtype=np.uint64) ^ self.salt)


def _signatures(n: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(rows, bands)
        for batch in batches:
            sets = ngram_sets(batch.column(2).to_pylist(), n)
            a = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            b = [int(np.bitwise_xor.reduce(s * np.uint64(0xD6E8FEB86659FD93), initial=np.uint64(0)).view(np.int64)) for s in sets]
            own = [hasher.band_hashes(s).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            flat = np.concatenate([*own, np.zeros(0, np.int64)])
            offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["row_key", "doc_id", "n", "sum", "xor", "bands"],
            )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the blocks of rows (family, n, key), which come sorted."""
    block, held, grams, family = TaskContext.get().partitionId() << 32, 0, 0, None
    for batch in batches:
        out = []
        for f, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if f != family or held == BLOCK_CLASSES or held and grams + n > BLOCK_NGRAMS:
                block, held, grams, family = block + 1, 0, 0, f
            held, grams = held + 1, grams + n
            out.append(block)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=["family", "n", "key", "block"])


def similar(sets: list[np.ndarray], side: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs (i, j), i < j, of different sides - or of one side, if there is one - with at least the similarity."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    common = np.zeros(m * m, np.int64)
    at = np.arange(len(flat))
    for d in range(1, m):
        at = at[at + d < len(flat)]
        at = at[flat[at] == flat[at + d]]
        if not len(at):
            break
        common += np.bincount(owner[at] * m + owner[at + d], minlength=m * m)
    common = common.reshape(m, m)
    common = np.triu(common + common.T, 1)
    ok = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-9
    ok &= common > 0
    if len(set(side.tolist())) > 1:
        ok &= side[:, None] != side[None, :]
    return np.argwhere(ok)


def _compared(n: int, similarity: float):
    def one(rows: dict[int, tuple[int, int, str]]) -> Iterator[tuple[int, int, int]]:
        """rows: key -> (block, copies, text)."""
        keys = sorted(rows)
        if len(keys) < 2:
            return
        pairs = similar(ngram_sets([rows[k][2] for k in keys], n), np.array([rows[k][0] for k in keys]), similarity)
        links, root = [0] * len(keys), list(range(len(keys)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in pairs.tolist():
            links[i] += rows[keys[j]][1]
            links[j] += rows[keys[i]][1]
            a, b = sorted((find(i), find(j)))
            root[b] = a
        for i, k in enumerate(keys):
            if links[i]:
                yield k, keys[find(i)], links[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held, out = None, {}, []
        for batch in batches:
            for a, b, block, key, copies, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b) != pair:
                    out += one(held)
                    pair, held = (a, b), {}
                held[key] = (block, copies, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["key", "other", "links"])
                out = []
        out += one(held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["key", "other", "links"])

    return run


def classify(docs: DataFrame, n: int = NGRAM, similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """One row per document (doc_id, text): its class and its links.

    A link joins two documents whose sets of word ``n``-grams (words folded in
    case, without punctuation; fewer than n words are one gram) have a Jaccard
    similarity of at least ``similarity``.  class_id is the smallest doc_id of
    all that hang together by links (null if they have none), class_key a
    number of the class, n_links how many other rows a row is linked to;
    row_key is xxhash64 of doc_id and text.

    A null, empty or wordless text is a class by itself, with its doc_id as
    class_id and a null class_key.  Repeated rows are documents each, linked to each other.
    """
    spark = docs.sparkSession
    bands = bands_for(similarity, rows, recall)
    text = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.when(F.col("n") > 0, F.xxhash64("n", "sum", "xor")).alias("key")
    signed = stage(
        text.mapInArrow(_signatures(n, rows, bands), "row_key long, doc_id long, n long, sum long, xor long, bands array<long>").select("row_key", "doc_id", "n", key, "bands"),
        "signatures",
    )
    of_key = signed.filter("key is not null").groupBy("key").agg(
        F.min("row_key").alias("row_key"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = stage(of_key, "classes")

    met = classes.select("key", F.explode("bands").alias("bucket"))
    leaders = met.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("m")).filter("m > 1").select("bucket", "leader")
    # the same plan at every size: both sides are shuffled, and a hot bucket can be split
    edges = met.join(leaders.hint("merge"), "bucket").filter("key != leader").select(F.col("key").alias("a"), F.col("leader").alias("b"))
    family = connected_components(edges).select(F.col("id").alias("key"), F.col("component").alias("family"))

    members = stage(family.join(classes.drop("bands"), "key"), "members")
    block_of = stage(
        members.select("family", "n", "key").repartitionByRange("family", "n", "key").sortWithinPartitions("family", "n", "key")
        .mapInArrow(_blocks, "family long, n long, key long, block long"),
        "blocks",
    )
    blocks = stage(block_of.groupBy("family", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "block_sizes")
    a, b = (blocks.select("family", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "lo", "hi")]) for s in "ab")
    pairs = a.join(b, "family").filter(
        (F.col("block_a") <= F.col("block_b")) & (F.col("lo_b") * similarity <= F.col("hi_a")) & (F.col("lo_a") * similarity <= F.col("hi_b"))
    ).select("block_a", "block_b", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    slots = block_of.select("key", "block").join(members.select("key", "row_key", "copies"), "key").join(pairs, "block")
    # the texts come last, so that they are shuffled to their pairs of blocks once
    to_compare = slots.join(text.select("row_key", "text").hint("merge"), "row_key").select("block_a", "block_b", "block", "key", "copies", "text")
    compared = stage(
        to_compare.repartition("block_a", "block_b").sortWithinPartitions("block_a", "block_b")
        .mapInArrow(_compared(n, similarity), "key long, other long, links long"),
        "links",
    )
    hangs = connected_components(compared.select(F.col("key").alias("a"), F.col("other").alias("b")))
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "first_id", "copies")
        .join(links, "key", "left")
        .join(hangs.select(F.col("id").alias("key"), "component"), "key", "left")
        .select("key", "first_id", F.coalesce("component", "key").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    )
    named = stage(named, "named")
    first = named.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    of_class = named.join(first, "class_key").select("key", "class_key", "class_id", "n_links")
    rest = signed.filter("key is null").select("row_key", "doc_id", F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    return signed.filter("key is not null").join(of_class, "key").select("row_key", "doc_id", "class_id", "class_key", "n_links").unionByName(rest)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class: the one with the smallest doc_id (null if there is no other).

    Of several rows with that id one stays.  All rows without words stay.
    """
    key = fresh_name(docs, "row_key")
    own = stage(classify(docs.select("doc_id", "text"), **options).filter("n_links > 0").select("row_key", "doc_id", "class_id", "class_key"), "linked")
    first = own.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(F.min("row_key").alias("chosen"), F.count("*").alias("m"))
    # of a class, the chosen row stays - one of it, if it is there several times
    verdict = stage(
        own.join(first, "class_key").groupBy("row_key").agg(F.max(F.when(F.col("row_key") == F.col("chosen"), F.when(F.col("m") > 1, 1).otherwise(2)).otherwise(0)).alias("stays"))
        .filter("stays < 2").select(F.col("row_key").alias(key), "stays"),
        "verdicts",
    )
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    gone = verdict.select(key)
    kept = marked.join(gone, key, "left_anti")
    repeated = verdict.filter("stays = 1").select(key)
    if not repeated.isEmpty():
        kept = kept.unionByName(marked.join(repeated, key, "left_semi").dropDuplicates([key]))
    return kept.drop(key)
