"""Near duplicates by an inverted join of MinHash signatures' coordinates.

* Texts with the same set of word shingles are one class, known by a 128-bit hash
  of the set; everything after works on classes.
* A class has ``COORDINATES`` minimum hashes.  Each is posted as a pair (coordinate,
  value); a pair that only one class has is skipped.  Two classes at the similarity
  agree in at least ``matches`` coordinates (missed with a chance of ``MISS``), so
  they share one of the rarest ``COORDINATES - matches + 1`` of each: only that
  prefix stays posted, and a class without as many common pairs is skipped whole.
* Of a posting list, the smallest class is the leader; the lists of a leader are
  one group.  A group is compared with its ``PIVOTS`` smallest classes: collisions
  are counted, and pairs with enough of them are confirmed on the full sets.
* Classes of a group that now hang together need no more comparing.  What is left
  of a group is cut into blocks, a large component into blocks of its own; blocks
  with several components, and pairs of blocks of different ones, are compared the
  same way.  What is left of most groups is one block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopshift.llm.common import SALTS, each_salt, salt, salts, stage
from shopshift.llm.components import connected_components
from shopshift.llm.words import Words, chunks, mix, shingles

#: Words of a shingle, and the similarity in hundredths.
SHINGLE, PERCENT = 5, 85
#: Length of a signature, and the chance that a pair at the similarity agrees in too few of its coordinates.
COORDINATES, MISS = 64, 1e-7
#: Classes that every other of a group is compared with first, and how many others meet them in one task.
PIVOTS, OTHERS = 64, 256
#: A block holds about as many classes, or as many shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1_000_000

_rng = np.random.default_rng(12)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def matches(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most coordinates that a pair of the similarity agrees in, but for a chance of ``miss``."""
    below = 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def spaced_words(texts: list[str]) -> Words:
    """The words of ``texts``: runs of anything but space and U+0009 to U+000D, A to Z folded to lower case."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(t) + 1 for t in data], np.int64)
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    part = ~_SPACE[raw]
    edge = np.diff(part.astype(np.int8), prepend=0)
    start = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    none = np.zeros(0, np.int64)
    if not len(start):
        return Words(len(texts), np.zeros(0, np.uint64), none, none, none, raw, part)
    length = end - start
    at = np.flatnonzero(part)
    place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    power = np.multiply.accumulate(np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64))
    byte = raw[at]
    value = _BYTE[byte + np.uint8(32) * ((byte >= 65) & (byte <= 90))] * power[place]
    first = np.cumsum(length) - length
    text = np.searchsorted(np.cumsum(size), start, side="right")
    return Words(len(texts), mix(np.add.reduceat(value, first) + length.astype(np.uint64)), text, start, end, raw, part)


def shingle_sets(texts: list[str], n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's runs of ``n`` words (all its words, if fewer)."""
    out: list[np.ndarray] = []
    for _, part in chunks(texts):
        h, text = shingles(spaced_words(part), n)
        at = np.searchsorted(text, np.arange(len(part) + 1))
        out += [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


class Signatures:
    """Minimum hashes of shingle sets under ``coordinates`` permutations of 32 bits."""

    def __init__(self, coordinates: int, seed: int = 85) -> None:
        rng = np.random.default_rng(seed)
        self.factor = (rng.integers(0, 2**31, coordinates, dtype=np.uint32) * 2 + 1)[:, None]
        self.flip = rng.integers(0, 2**32, coordinates, dtype=np.uint32)[:, None]
        self.number = np.arange(coordinates, dtype=np.int64) << 32

    def of(self, own: np.ndarray) -> np.ndarray:
        """(coordinate, value) pairs, each as one number; ``own`` is not empty."""
        low = np.full(len(self.number), 2**32 - 1, np.uint32)
        x = (own >> np.uint64(32)).astype(np.uint32)
        for s in range(0, len(x), 512):
            np.minimum(low, ((x[s : s + 512] ^ self.flip) * self.factor).min(axis=1), out=low)
        return self.number | low


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([*values, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64)))


def _slices(column: pa.ListArray) -> list[np.ndarray]:
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _signed(n: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signatures(coordinates)
        for batch in batches:
            sets = shingle_sets(batch.column(2).to_pylist(), n)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            own = [signer.of(s) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), _lists(own)],
                names=["row_key", "doc_id", "key", "n", "sig"],
            )

    return run


def _with_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(2).to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(sets)], names=["id", "sig", "own"])

    return run


class Held:
    """The classes of one side of a comparison, and how they hang together."""

    def __init__(self, least: int, percent: int) -> None:
        self.least, self.percent = least, percent
        self.ids: list[int] = []
        self.component: list[int] = []
        self.sigs: list[np.ndarray] = []
        self.sets: list[np.ndarray] = []
        self.index = None

    def add(self, key: int, component: int, sig: np.ndarray, own: np.ndarray) -> None:
        self.ids.append(key)
        self.component.append(component)
        self.sigs.append(sig)
        self.sets.append(own)

    def build(self) -> None:
        size = np.array([len(s) for s in self.sets])
        flat = np.concatenate(self.sets)
        order = np.argsort(flat, kind="stable")
        self.index = flat[order], np.repeat(np.arange(len(size)), size)[order], size, np.array(self.sigs), np.array(self.component)
        self.root = list(range(len(size)))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def linked(self, component: int, sig: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The held classes, of other components, that the given one is linked with."""
        flat, owner, size, sigs, components = self.index
        near = np.flatnonzero(((sigs == sig).sum(axis=1) >= self.least) & (components != component))
        if not len(near):
            return near
        lo, hi = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
        count = hi - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(owner[at], minlength=len(size))[near]
        return near[100 * both >= self.percent * (size[near] + len(own) - both)]

    def edges(self, key: int, links: np.ndarray, own: int | None = None) -> Iterator[tuple[int, int]]:
        """Edges that say as much as the links of ``key`` (the held class ``own``, if it is one) and all links before."""
        first = None if own is None else self.find(own)
        for j in map(self.find, links.tolist()):
            if first is None:
                first = j
                yield key, self.ids[j]
            elif j != first:
                yield self.ids[first], self.ids[j]
                self.root[j] = first

    def inside(self) -> Iterator[tuple[int, int]]:
        """Edges among the held classes."""
        for i, key in enumerate(self.ids):
            links = self.linked(self.component[i], self.sigs[i], self.sets[i])
            yield from self.edges(key, links[links < i], i)


def _compared(least: int, percent: int):
    """Edges of the units (a, b), which come sorted: side 0 with side 1, or with itself where there is no side 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, out = None, None, []

        def flush():
            cols = zip(*out, strict=True) if out else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

        for batch in batches:
            plain = (batch.column(k).to_pylist() for k in range(5))
            for a, b, side, key, component, sig, own in zip(*plain, _slices(batch.column(5)), _slices(batch.column(6)), strict=True):
                if (a, b) != unit:
                    if held is not None and held.index is None:  # a unit of one side
                        held.build()
                        out += held.inside()
                    unit, held = (a, b), Held(least, percent)
                if side == 0:
                    held.add(key, component, sig.copy(), own.copy())
                    continue
                if held.index is None:
                    held.build()
                out += held.edges(key, held.linked(component, sig, own))
            if out:
                yield flush()
                out = []
        if held is not None and held.index is None:
            held.build()
            out += held.inside()
        if out:
            yield flush()

    return run


def _candidates(classes: DataFrame, least: int) -> DataFrame:
    """(leader, id, salt): the groups of classes that share a posting of their prefixes."""
    tokens = classes.select("id", F.explode("sig").alias("token")).withColumn("salt", salt("id"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df"), salts()).filter("df > 1")
    shared = tokens.join(each_salt(common), ["token", "salt"]).select("id", "token", "df")
    ranked = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own")).filter(F.size("own") >= least)
    posts = ranked.select("id", F.explode(F.slice("own", F.lit(1), F.size("own") - (least - 1))).alias("p")).select("id", F.col("p.token").alias("token"))
    posts = stage(posts.withColumn("salt", salt("id")), "posts")
    lists = posts.groupBy("token").agg(F.min("id").alias("leader"), F.max("id").alias("last"), salts()).filter("leader < last")
    return posts.join(each_salt(lists.drop("last")), ["token", "salt"]).select("leader", "id", "salt").distinct()


def _link(units: DataFrame, sets: DataFrame, least: int, percent: int, name: str) -> DataFrame:
    """Edges (a, b) of units (a, b, side, id, component)."""
    rows = units.join(sets, "id").select("a", "b", "side", "id", "component", "sig", "own")
    edges = rows.repartition("a", "b").sortWithinPartitions("a", "b", "side").mapInArrow(_compared(least, percent), "a long, b long")
    return stage(edges, name)


def _rest(rest: DataFrame, edges: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame | None:
    """Edges of the classes beside the pivots that are in different components of their group; None if there are none."""
    named = connected_components(edges)
    rest = stage(rest.join(named, "id", "left").select("leader", "id", "salt", "n", F.coalesce("component", "id").alias("component")), "rest")
    several = rest.groupBy("leader").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), salts()).filter("lo < hi")
    left = stage(rest.join(each_salt(several.drop("lo", "hi")), ["leader", "salt"]).select("leader", "component", "n", "id"), "left")
    if left.isEmpty():
        return None
    order = ["leader", "component", "n", "id"]
    # blocks by hash, of about equal size: a component that fills one has its own, the others share theirs
    sized = left.withColumn("salt", salt("id")).groupBy("leader", "component").agg(F.count("*").alias("m"), F.sum("n").alias("size"), salts())
    full = F.greatest(F.col("m") / BLOCK_CLASSES, F.col("size") / BLOCK_SHINGLES)
    sized = stage(sized.withColumn("own", F.when(full >= 1, F.col("component")).otherwise(-1)).withColumn("full", full), "sized")
    count = sized.groupBy("leader", "own").agg(F.ceil(F.sum("full")).cast("long").alias("blocks"))
    of_component = sized.join(count, ["leader", "own"]).select("leader", "component", "own", "blocks", "salts")
    place = F.xxhash64("leader", "own", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("blocks"))).alias("block")
    blocks = left.withColumn("salt", salt("id")).join(each_salt(of_component), ["leader", "component", "salt"])
    blocks = stage(blocks.select("leader", "component", "n", "id", place), "blocks")
    sizes = stage(
        blocks.groupBy("leader", "block").agg(
            F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("component").alias("one"), F.max("component").alias("other")
        ),
        "block_sizes",
    )
    a, b = (sizes.select("leader", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "lo", "hi", "one", "other")]) for s in "ab")
    a = a.withColumn("salt", salt("block_a"))
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = a.join(b, ["leader", "salt"]).filter(
        (F.col("block_a") <= F.col("block_b"))
        & ((F.col("one_a") != F.col("other_a")) | (F.col("one_b") != F.col("other_b")) | (F.col("one_a") != F.col("one_b")))
        & (F.col("lo_b") * percent <= F.col("hi_a") * 100)
        & (F.col("lo_a") * percent <= F.col("hi_b") * 100)
    ).select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))
    sides = pairs.select("a", "b", F.lit(0).alias("side"), F.col("a").alias("block")).unionAll(
        pairs.filter("a < b").select("a", "b", F.lit(1).alias("side"), F.col("b").alias("block"))
    )
    units = sides.join(blocks.select("block", "id", "component"), "block")
    return _link(units, sets, least, percent, "rest_edges")


def dedup(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of anything but space and U+0009 to U+000D, A to Z folded; a
    document's set holds its distinct runs of ``n`` words, or all its words as
    one run if it has fewer.  Documents are linked if their sets' Jaccard
    similarity is at least ``percent`` hundredths.  component_id is the smallest
    doc_id of all that hang together by links (null if none of them has one);
    kept says whether that is the document's own (null equals null).

    A null, empty or wordless text has no shingles, is linked with nothing and
    is kept.  Repeated rows are documents each, linked to each other; all of
    those with the component's id are kept.  Other columns are not read.
    """
    least = matches(percent / 100)
    text = docs.select(
        F.xxhash64("doc_id", "text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    schema = "row_key long, doc_id long, key binary, n long, sig array<long>"
    signed = stage(text.mapInArrow(_signed(n, COORDINATES), schema).withColumn("salt", salt("row_key")), "signed")
    of_key = signed.filter("key is not null").groupBy("key").agg(
        F.min("row_key").alias("row_key"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sig").alias("sig"), salts()
    )
    # the numbers are fixed by being written
    classes = stage(of_key.withColumn("id", F.monotonically_increasing_id()), "classes")

    groups = stage(_candidates(classes, least), "groups")
    wanted = groups.select("id").distinct().join(classes.select("id", "row_key", "sig"), "id")
    # one text of each row key: repeated rows meet before the shuffle
    texts = text.groupBy("row_key").agg(F.first("text").alias("text"))
    sets = stage(texts.join(wanted, "row_key").select("id", "sig", "text").mapInArrow(_with_sets(n), "id long, sig array<long>, own array<long>"), "sets")

    smallest = Window.partitionBy("leader").orderBy("id")
    pivots = stage(groups.select("leader", "id", F.row_number().over(smallest).alias("place")).filter(F.col("place") <= PIVOTS).select("leader", "id"), "pivots")
    rest = stage(groups.join(pivots, ["leader", "id"], "left_anti").join(classes.select("id", "n"), "id"), "others")
    # the others of a large group are dealt to several tasks, each of which has all pivots
    others = rest.groupBy("leader").agg(F.least(F.lit(SALTS), F.ceil(F.count("*") / OTHERS)).cast("int").alias("parts"), salts())
    others = stage(others, "parts")
    dealt = rest.join(each_salt(others), ["leader", "salt"]).select("leader", (F.col("salt") % F.col("parts")).alias("part"), "id")
    places = others.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    places = places.unionByName(pivots.select("leader").distinct().withColumn("part", F.lit(-1)))
    units = places.join(pivots, "leader").select(F.col("leader").alias("a"), F.col("part").alias("b"), F.lit(0).alias("side"), "id").unionAll(
        dealt.select("leader", "part", F.lit(1), "id")
    )
    edges = _link(units.select(F.col("a"), F.col("b").cast("long").alias("b"), "side", "id", F.col("id").alias("component")), sets, least, percent, "edges")
    more = _rest(rest, edges, sets, least, percent)
    named = connected_components(edges if more is None else edges.unionAll(more))

    of_class = classes.select("id", "key", "first_id", "salts").join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))
    of_class = stage(of_class.withColumn("salt", salt("id")), "components")
    first = of_class.groupBy("component").agg(F.min("first_id").alias("component_id"), salts())
    named = of_class.join(each_salt(first), ["component", "salt"]).select("key", of_class["salts"], "component_id")
    own = signed.join(each_salt(named), ["key", "salt"]).select("doc_id", "n", "component_id")
    rows = own.unionAll(signed.filter("key is null").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
