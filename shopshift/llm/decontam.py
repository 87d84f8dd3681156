"""Benchmark decontamination by template windows.

Texts become template tokens: numbers, names and units turn into typed
placeholders, other words stay.  Windows of ``WINDOW`` template tokens are
hash-joined between documents and benchmark items; an item whose windows are
found in a document, with the same document value wherever the item repeats a
slot's value, is contained in it - also as a re-parameterised question.
Windows of the plain words, whatever their case, are joined as well: a run of
``RUN`` words of an item, or all words of a shorter one, is contained too.

A bitmap of the benchmark's window hashes (``BITMAP_BITS``, whatever the size
of the benchmark) goes to the tasks, so that only windows that may match are
shuffled; the join decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import fresh_name, stage
from shopshift.llm.words import Words, chunks, mix, word_hash, words

WINDOW = 8
#: Words in a window that are no placeholders, at least; fewer say nothing about a question.
LITERALS = 4
#: Share of an item's template windows that make it contained.
COVERAGE = 0.5
#: Plain words in a row that make an item contained, whatever its length; a shorter item is looked for as a whole.
RUN = 13
#: Which tokens a window is of: the template's, those of the text in small letters, plain words.
TEMPLATE, FOLDED, PLAIN = 0, 1, 2
BITMAP_BITS = 1 << 23

#: Words that are units behind a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz pound pounds ounce ounces ton tons tonne tonnes ml l liter "
    "liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hrs hour hours day days week weeks month months year "
    "years mph kmh kph hz khz mhz ghz v w kw kwh j kj cal kcal n pa kpa k c f degree degrees percent cent cents dollar dollars euro euros usd eur gbp "
    "kb mb gb tb"
).split()
NUMBER, NAME, UNIT = 1, 2, 3
_PLACEHOLDERS = mix(np.arange(4, dtype=np.uint64) + np.uint64(0x5EED))
_POWER = np.multiply.accumulate(np.full(64, 0xD6E8FEB86659FD93, np.uint64))
_unit_hashes: list[np.ndarray] = []


def _units() -> np.ndarray:
    if not _unit_hashes:
        _unit_hashes.append(np.sort(np.array([word_hash(u) for u in UNITS], np.uint64)))
    return _unit_hashes[0]


@dataclass
class Tokens:
    """Template tokens: hash, kind (0: a word), hash of the words behind a placeholder, text."""

    hash: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    text: np.ndarray


def template(own: Words) -> Tokens:
    """Template tokens of words.

    A number is a word of digits; a unit is a unit's name behind a number; a
    name is a capitalised word one space behind another word.  Neighbouring
    numbers are one token (1,234.5 is four words), and so are neighbouring names.
    """
    n = len(own.hash)
    if not n:
        return Tokens(own.hash, np.zeros(0, np.int8), own.hash, own.text)
    digits = np.cumsum(np.append(0, (own.raw >= 48) & (own.raw <= 57)))
    capitals = np.cumsum(np.append(0, own.upper))
    follows = np.zeros(n, bool)
    follows[1:] = own.text[1:] == own.text[:-1]
    kind = np.zeros(n, np.int8)
    kind[digits[own.end] - digits[own.start] == own.end - own.start] = NUMBER
    spaced = np.zeros(n, bool)
    spaced[1:] = follows[1:] & (own.start[1:] - own.end[:-1] == 1) & (own.raw[own.end[:-1]] == 32)
    titled = own.upper[own.start] & (capitals[own.end] - capitals[own.start] == 1) & (own.end - own.start > 1)
    kind[spaced & titled & (kind == 0)] = NAME
    behind = np.zeros(n, bool)
    behind[1:] = follows[1:] & (kind[:-1] == NUMBER)
    units = _units()
    known = units[np.minimum(np.searchsorted(units, own.hash), len(units) - 1)] == own.hash
    kind[behind & known & (kind != NUMBER)] = UNIT
    joins = np.zeros(n, bool)
    joins[1:] = follows[1:] & (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME))
    first = np.flatnonzero(~joins)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    value = np.add.reduceat(mix(own.hash + place.astype(np.uint64)), first)
    hashes = np.where(kind[first] == 0, own.hash[first], _PLACEHOLDERS[kind[first]])
    return Tokens(hashes, kind[first], value, own.text[first])


def plain(own: Words) -> Tokens:
    """The words as they are; numbers with one space, point or comma between them (1,234.5 or 1 234) are one."""
    n = len(own.hash)
    if not n:
        return Tokens(own.hash, np.zeros(0, np.int8), own.hash, own.text)
    digits = np.cumsum(np.append(0, (own.raw >= 48) & (own.raw <= 57)))
    number = digits[own.end] - digits[own.start] == own.end - own.start
    between = own.raw[own.end[:-1]]
    joins = np.zeros(n, bool)
    joins[1:] = (own.text[1:] == own.text[:-1]) & number[1:] & number[:-1] & (own.start[1:] - own.end[:-1] == 1) & ((between == 32) | (between == 44) | (between == 46))
    first = np.flatnonzero(~joins)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    value = np.add.reduceat(mix(own.hash + place.astype(np.uint64)), first)
    return Tokens(value, np.zeros(len(first), np.int8), value, own.text[first])


def windows(t: Tokens, size: int, least: int = LITERALS, salt: int = TEMPLATE) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of every window of ``size`` tokens with ``least`` or more words."""
    m = max(len(t.hash) - size + 1, 0)
    acc = np.full(m, size + (salt << 32), np.uint64)
    for k in range(size):
        acc += t.hash[k : k + m] * _POWER[k]
    literal = np.cumsum(np.append(0, t.kind == 0))
    fits = (literal[size:] - literal[:-size])[:m] >= least
    if m:
        fits &= t.text[:m] == t.text[size - 1 : size - 1 + m]
    at = np.flatnonzero(fits)
    return at, mix(acc[at])


def _slots(t: Tokens, at: int, size: int) -> list[int]:
    """Values behind the window's placeholders, as signed numbers."""
    own = slice(at, at + size)
    return t.value[own][t.kind[own] > 0].view(np.int64).tolist()


_WINDOWS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("of", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64()))])
_FIELDS = "key long, id long, at long, n int, of int, hash long, slots array<long>"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * len(_WINDOWS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _WINDOWS, strict=True)], schema=_WINDOWS)


def _of_item(text: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[list[int]]]]:
    """(tokens' kind, size, places, hashes, slots) of an item's windows.

    Its template is taken alone and behind another word, which makes a name of a capitalised first word; places are
    counted so that both agree from there on.  A copy in small letters or capitals has no names: its template is the
    folded one.
    """
    alone = template(words([text]))
    after = template(words(["a " + text]))
    after = Tokens(after.hash[1:], after.kind[1:], after.value[1:], after.text[1:])
    folded = template(words([text.lower()]))
    for of, t in ((TEMPLATE, alone), (TEMPLATE, after), (FOLDED, folded)):
        if t is alone or not np.array_equal(t.hash, alone.hash):
            size = min(WINDOW, len(t.hash))
            at, hashes = windows(t, size) if size >= LITERALS else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            shift = len(alone.hash) - len(t.hash) if of == TEMPLATE else 0
            yield of, size, at + shift, hashes, [_slots(t, int(a), size) for a in at]
    t = plain(words([text]))
    size = min(RUN, len(t.hash))
    if size:
        at, hashes = windows(t, size, 0, PLAIN)
        yield PLAIN, size, at, hashes, [[] for _ in at]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of every item; ``n`` is the number of its places, ``key`` the window's size."""
    for batch in batches:
        rows = []
        for item, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            seen: dict[tuple[int, int, int], tuple[int, list[int]]] = {}
            for of, size, at, hashes, slots in _of_item(text):
                for a, h, own in zip(at.tolist(), hashes.view(np.int64).tolist(), slots, strict=True):
                    seen.setdefault((of, a, h), (size, own))
            places = Counter(of for of, _ in {(of, a) for of, a, _ in seen})
            rows += [(size, item, a, places[of], of, h, own) for (of, a, h), (size, own) in seen.items()]
        yield _rows(rows)


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits, sizes = np.zeros(BITMAP_BITS // 8, np.uint8), set()
    for batch in batches:
        h = batch.column(0).to_numpy().view(np.uint64) % np.uint64(BITMAP_BITS)
        np.bitwise_or.at(bits, (h >> np.uint64(3)).astype(np.int64), np.uint8(1) << (h & np.uint64(7)).astype(np.uint8))
        sizes |= {2 * size + (of == PLAIN) for size, of in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)}
    # a size is twice itself, and one more for plain words
    yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()]), pa.array([sorted(sizes)], pa.list_(pa.int64()))], names=["bits", "sizes"])


def _doc_windows(bits: np.ndarray, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in chunks(batch.column(2).to_pylist()):
                own_words = words(texts)
                rows = []
                for of, t in ((TEMPLATE, template(own_words)), (PLAIN, plain(own_words))):
                    begin = np.searchsorted(t.text, np.arange(len(texts)))
                    for size in (x >> 1 for x in sizes if x & 1 == (of == PLAIN)):
                        at, hashes = windows(t, size, 0, PLAIN) if of == PLAIN else windows(t, size)
                        h = hashes % np.uint64(BITMAP_BITS)
                        hit = np.flatnonzero(bits[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1)
                        if of == PLAIN:  # one place in a text will do
                            hit = hit[np.unique(np.stack([t.text[at[hit]], hashes[hit].view(np.int64)]), axis=1, return_index=True)[1]]
                        for a, own in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist(), strict=True):
                            i = int(t.text[a])
                            rows.append((key[first + i], doc[first + i], a - int(begin[i]), size, of, own, _slots(t, a, size)))
                yield _rows(rows)

    return run


def _row_key(text: str, doc_id: str):
    return F.xxhash64(doc_id, text)


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items of ``benchmark`` (item_id, text) that documents (doc_id, text) contain.

    Returns row_key (xxhash64 of doc_id and text), doc_id, item_id, n_windows,
    n_found and n_slots (slot values that were matched), one row for each
    document and item; the windows are the template's if these say so, or else
    those in small letters or of plain words.  Only windows count whose alignment (document place
    less item place) gives each slot value of the item one value in the
    document.  Null and empty texts contain nothing and are contained in
    nothing; repeated documents give the same rows once; repeated items are
    found each.
    """
    spark = docs.sparkSession
    items = stage(
        benchmark.filter(F.col("text").isNotNull() & F.col("item_id").isNotNull())
        .select(F.lit(0).cast("long").alias("key"), F.col("item_id").cast("long").alias("id"), "text")
        .mapInArrow(_item_windows, _FIELDS),
        "item_windows",
    )
    # a bitmap of BITMAP_BITS from each of 16 tasks at most
    maps = items.select("hash", "key", "of").coalesce(16).mapInArrow(_bitmap, "bits binary, sizes array<long>").collect()
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in maps:
        bits |= np.frombuffer(r.bits, np.uint8)
    sizes = sorted({s for r in maps for s in r.sizes})
    found = (
        docs.filter(F.col("text").isNotNull())
        .select(_row_key("text", "doc_id").alias("key"), F.col("doc_id").cast("long").alias("id"), "text")
        .mapInArrow(_doc_windows(bits, sizes), _FIELDS)
        .select(F.col("key").alias("row_key"), F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "hash", F.col("slots").alias("doc_slots"))
    )
    known = items.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("n").alias("n_windows"), "of", "hash", F.col("slots").alias("item_slots"))
    pairs = F.arrays_zip("item_slots", "doc_slots")
    by_alignment = (
        found.join(known, "hash")
        .groupBy("row_key", "item_id", "of", (F.col("doc_at") - F.col("item_at")).alias("shift"))
        # an alignment has a window of the item at most once
        .agg(F.first("doc_id").alias("doc_id"), F.first("n_windows").alias("n_windows"), F.collect_set("item_at").alias("at"), F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs"))
        .filter(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))))
    )
    whole = by_alignment.groupBy("row_key", "item_id", "of").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_windows").alias("n_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_found"), F.max(F.size("pairs")).alias("n_slots"),
    )
    enough = whole.filter((F.col("of") == PLAIN) | (F.col("n_found") >= COVERAGE * F.col("n_windows")))
    best = enough.groupBy("row_key", "item_id").agg(F.min(F.struct("of", "doc_id", "n_windows", "n_found", "n_slots")).alias("b"))
    return best.select("row_key", "b.doc_id", "item_id", "b.n_windows", "b.n_found", "b.n_slots")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item of ``benchmark``, with all their columns."""
    key = fresh_name(docs, "row_key")
    bad = stage(contained(docs.select("doc_id", "text"), benchmark).select(F.col("row_key").alias(key)).distinct(), "contaminated")
    return docs.withColumn(key, _row_key("text", "doc_id")).join(bad, key, "left_anti").drop(key)
