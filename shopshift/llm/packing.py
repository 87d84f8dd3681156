"""Best-fit packing of tokenized documents by bin completion.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (``capacity`` counts at most, whatever the corpus) is planned at
the driver.  Best-fit decreasing is the incumbent.  Where it misses the lower
bound, bin completion searches depth first for a number of sequences below it,
the bound first: it takes the largest length left, branches over all
undominated fillings of what that leaves free and over how often each is used,
and leaves a branch when its waste and a lower bound of the waste to come are
more than that number allows.  Spark numbers the pieces of each length (in salted parts, so
that one length may hold any share of them) and every piece finds its place by
its number.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopshift.llm.common import stage

#: Bytes of text that are tokenized together, and tokens kept of words seen before.  Every Python worker holds the
#: arrays of either: about fifty bytes for a byte of text, and up to thirty for a token.
CHUNK_BYTES = 1 << 18
CACHE_TOKENS = 1 << 20
#: Fillings looked at for one largest length by the first, greedy completion.
NODES = 400
#: Steps of the branch and bound (lengths and fillings looked at) for one number of sequences; then a larger one is tried.
STEPS = 500_000
#: Pieces numbered by one task, about; the numbers of parts of a length are within these.
PIECES_PER_PART, PARTS = 200_000, (16, 1024)

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: A byte after a space that may start a white-space character beyond ASCII.
_MAYBE_WHITE = np.zeros(256, bool)
_MAYBE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class ByteLevelTokenizer:
    """Token ids of whole texts; a word met before is looked up and not tokenized again.

    Byte-level BPE never joins what is left and right of a single space between
    two characters that are no white space, so a text is cut there.  The words
    are hashed and made distinct for a whole chunk of texts at once, the new
    ones go through ``tokenizers``.  A tokenizer of another kind encodes each
    text as it is.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        spec = json.loads(Path(path).read_text())
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(token)  # a character for each byte
        rng = np.random.default_rng(1)
        self.mix = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.power = np.multiply.accumulate(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, uint32."""
        if not self.by_word:
            return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            held.append(text.encode())
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                out += self._chunk(held)
                held, size = [], 0
        return out + self._chunk(held)

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(t) for t in texts], np.int64)
        data = b"".join(texts)
        n = len(data)
        if not n:
            return [np.zeros(0, np.uint32) for _ in texts]
        buf = np.frombuffer(data, np.uint8)
        doc_at = np.cumsum(size) - size
        begins = np.zeros(n + 1, bool)
        begins[doc_at] = True
        space = np.flatnonzero(buf == 32)
        space = space[(space > 1) & (space < n - 1)]
        space = space[~begins[space] & ~begins[space + 1]]
        left, left2, right = buf[space - 1], buf[space - 2], buf[space + 1]
        sure = np.where(left < 128, ~_WHITE[left], (left2 >= 0xC3) & (left2 <= 0xDF)) & ~_WHITE[right] & ~_MAYBE_WHITE[right]
        cut = begins.copy()
        cut[space[sure]] = True
        start = np.flatnonzero(cut[:n])
        width = np.diff(np.append(start, n))
        value = self.mix[buf] * self.power[(np.arange(n) - np.repeat(start, width)) & 0xFFFF]
        key = np.add.reduceat(value, start) + width.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        known, first, which = np.unique(key, return_index=True, return_inverse=True)
        if self.used > CACHE_TOKENS:
            self.forget()
        place = np.searchsorted(self.keys, known)
        old = np.zeros(len(known), bool)
        if len(self.keys):
            old = self.keys[np.minimum(place, len(self.keys) - 1)] == known
        new = np.flatnonzero(~old)
        if len(new):
            at, count = self._learn(data, start[first[new]], width[first[new]], begins)
            self.keys = np.insert(self.keys, place[new], known[new])
            self.at = np.insert(self.at, place[new], at)
            self.size = np.insert(self.size, place[new], count)
            place = np.searchsorted(self.keys, known)
        at, count = self.at[place][which], self.size[place][which]
        ends = np.cumsum(count)
        ids = self.pool[np.repeat(at - (ends - count), count) + np.arange(ends[-1])]
        word_end = np.append(0, ends)[np.searchsorted(start, doc_at + size)]
        return [ids[b:e] for b, e in zip(np.append(0, word_end[:-1]), word_end, strict=True)]

    def _learn(self, data: bytes, start: np.ndarray, width: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokenize the words at ``start``; (place in the pool, number of ids) of each."""
        buf = np.frombuffer(data, np.uint8)
        last = buf[start + width - 1]
        inner = ~begins[start] & (~begins[start + width] & (start + width < len(data)) | (last < 128) & ~_WHITE[last])
        count = np.zeros(len(start), np.int64)
        parts: list[np.ndarray] = []
        order = np.concatenate([np.flatnonzero(inner), np.flatnonzero(~inner)])
        n_inner = int(inner.sum())
        # words that stand alone wherever they are put: joined, and told apart by their bytes
        for s in range(0, n_inner, 1 << 13):
            own = order[s : min(s + (1 << 13), n_inner)]
            joined = b"".join(data[a : a + w] for a, w in zip(start[own].tolist(), width[own].tolist(), strict=True)).decode()
            ids = np.array(self.tok.encode(joined, add_special_tokens=False).ids, np.uint32)
            token_end, word_end = np.cumsum(self.n_bytes[ids]), np.cumsum(width[own])
            upto = np.searchsorted(token_end, word_end) + 1
            if token_end[-1] != word_end[-1] or not np.array_equal(token_end[upto - 1], word_end):
                raise RuntimeError("the tokenizer joined words across a space")
            count[own] = np.diff(np.append(0, upto))
            parts.append(ids)
        rest = order[n_inner:]
        texts = [data[a : a + w].decode() for a, w in zip(start[rest].tolist(), width[rest].tolist(), strict=True)]
        for i, e in zip(rest, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            count[i] = len(e.ids)
            parts.append(np.array(e.ids, np.uint32))
        flat = np.concatenate(parts)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = np.empty(len(start), np.int64)
        at[order] = self.used + np.cumsum(count[order]) - count[order]
        self.used += len(flat)
        return at, count


_tokenizers: dict[str, ByteLevelTokenizer] = {}


def tokenizer(path: str) -> ByteLevelTokenizer:
    """The tokenizer of this process."""
    if path not in _tokenizers:
        _tokenizers[path] = ByteLevelTokenizer(path)
    return _tokenizers[path]


def piece_spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what is left over."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document (doc_id, text): its ids and then ``end_id``.

    A null text is empty.  ``ids_crc32`` is that of the ids as unsigned 32-bit
    little-endian numbers; ``keep_ids`` adds those bytes as column ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        end = np.array([end_id], "<u4")
        for batch in batches:
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), tok.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.concatenate([ids.astype("<u4"), end])
                for i, (s, n) in enumerate(piece_spans(len(ids), capacity)):
                    raw = ids[s : s + n].tobytes()
                    out.append((doc, i, s, n, zlib.crc32(raw), *([raw] if keep_ids else [])))
            cols = list(zip(*out, strict=True)) if out else [()] * (5 + keep_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids])

    text = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return text.mapInArrow(run, PIECES + ", ids binary" * keep_ids)


Plan = list[tuple[int, tuple[int, ...]]]


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on a histogram: (number of sequences, their lengths), for each kind of sequence."""
    bins: dict[int, dict[tuple[int, ...], int]] = {}
    free: list[int] = []

    def put(kind: tuple[int, ...], n: int, room: int) -> None:
        if room not in bins:
            bins[room] = {}
            insort(free, room)
        bins[room][kind] = bins[room].get(kind, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(free, length)
            if i == len(free):
                q = capacity // length
                if left >= q:
                    put((length,) * q, left // q, capacity - q * length)
                if left % q:
                    put((length,) * (left % q), 1, capacity - (left % q) * length)
                break
            room = free[i]
            kind, n = next(iter(bins[room].items()))
            used = min(n, left)
            if used == n:
                del bins[room][kind]
            else:
                bins[room][kind] = n - used
            if not bins[room]:
                del bins[room]
                free.pop(i)
            put((*kind, length), used, room - length)
            left -= used
    return [(n, kind) for room in sorted(bins) for kind, n in bins[room].items()]


def completion(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The filling of ``room`` that wastes least, longer pieces first among equals.

    ``lengths`` ascend.  A filling with a longer piece in the place of several
    shorter ones dominates; so the search goes from long to short, takes as
    little as possible, and leaves a branch when what it can still add does not
    reach the best filling.  At most ``NODES`` fillings are looked at.
    """
    best: list[int] = []
    best_sum, nodes = 0, 0

    def search(upto: int, room: int, own: list[int], total: int) -> None:
        nonlocal best, best_sum, nodes
        if total > best_sum:
            best, best_sum = own[:], total
        i = bisect_left(lengths, room + 1, 0, upto) - 1
        while i >= 0 and best_sum < total + room and nodes < NODES:
            length = lengths[i]
            fits = min(counts[length] - own.count(length), room // length)
            if fits > 0:
                nodes += 1
                own.append(length)
                search(i + 1, room - length, own, total + length)
                own.pop()
            i -= 1

    search(len(lengths), room, [], 0)
    return best


def complete_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Bin completion on a histogram, the largest length first."""
    left, out = {k: v for k, v in counts.items() if v}, []
    lengths = sorted(left)
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        kind = [largest, *completion(lengths, left, capacity - largest)]
        left[largest] += 1
        times = min(left[k] // kind.count(k) for k in set(kind))
        out.append((times, tuple(kind)))
        for k in kind:
            left[k] -= times
        for k in set(kind):
            if not left[k]:
                lengths.pop(bisect_left(lengths, k))
    return out


class Spent(Exception):
    """The search's steps are used up."""


class _Search:
    """Bin completion by branch and bound: a plan of at most ``most`` sequences."""

    def __init__(self, counts: dict[int, int], capacity: int, most: int, steps: int) -> None:
        self.capacity, self.steps = capacity, steps
        self.allowed = most * capacity - sum(k * v for k, v in counts.items())
        self.left = {k: v for k, v in counts.items() if v}

    def step(self, n: int = 1) -> None:
        self.steps -= n
        if self.steps < 0:
            raise Spent

    def sums(self, lengths: list[int], room: int) -> list[int]:
        """For each number of the shortest lengths, the sums up to ``room`` that they give, as bits."""
        out, full = [1], (1 << room + 1) - 1
        self.step(len(lengths))
        for k in lengths:
            bits, most, part = out[-1], min(self.left[k], room // k), 1
            while most > 0:
                take = min(part, most)
                bits |= bits << take * k & full
                most -= take
                part *= 2
            out.append(bits)
        return out

    def waste_to_come(self) -> int:
        """At least so much is wasted: no two pieces above half share a sequence, each meets its best sum."""
        half = self.capacity // 2
        big = [k for k in self.left if k > half]
        if not big:
            return 0
        reach = self.sums(sorted(k for k in self.left if k <= half), self.capacity - min(big))[-1]
        return sum(self.left[k] * (self.capacity - k - ((reach & (1 << self.capacity - k + 1) - 1).bit_length() - 1)) for k in big)

    def dominated(self, filling: tuple[int, ...], waste: int) -> bool:
        """A piece left over could take the place of shorter ones, of none, or of several with its length."""
        self.step(len(self.left) // 8)
        one, several = 0, 0
        for k in filling:
            several |= (one | several) << k
            one |= 1 << k
        spare = 0
        for k, n in self.left.items():
            if n > filling.count(k):
                spare |= 1 << k
        if several & spare:
            return True
        near, width = (one | several | 1) << 1, 1
        while width < waste:
            near |= near << min(width, waste - width)
            width *= 2
        return bool(waste and near & spare)

    def fillings(self, room: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(waste, lengths) of the undominated fillings of ``room``, least waste first, longest pieces first."""
        lengths = sorted(k for k in self.left if k <= room)
        reach = self.sums(lengths, room)

        def exact(upto: int, rest: int) -> Iterator[tuple[int, ...]]:
            if not rest:
                yield ()
                return
            i = min(upto, bisect_left(lengths, rest + 1)) - 1
            while i >= 0 and reach[i + 1] >> rest & 1:
                self.step()
                k = lengths[i]
                for m in range(min(self.left[k], rest // k), 0, -1):
                    if reach[i] >> rest - m * k & 1:
                        for more in exact(i, rest - m * k):
                            yield (k,) * m + more
                i -= 1

        for total in range(room, -1, -1):
            if reach[-1] >> total & 1:
                for filling in exact(len(lengths), total):
                    self.step()
                    if not self.dominated(filling, room - total):
                        yield room - total, filling

    def choices(self, wasted: int, done: set[tuple[int, ...]]) -> Iterator[tuple[int, tuple[int, ...], int, set[tuple[int, ...]]]]:
        """(times, sequence, waste, sequences done with) for the largest length left."""
        if wasted + self.waste_to_come() > self.allowed:
            return
        largest = max(self.left)
        found = self.fillings(self.capacity - largest)
        while True:
            self.use(1, (largest,))
            waste, filling = next(found, (self.allowed + 1, ()))
            self.use(-1, (largest,))
            if wasted + waste > self.allowed:
                return
            kind = (largest, *filling)
            if kind in done:
                continue
            done.add(kind)
            most = min(self.left[k] // kind.count(k) for k in set(kind))
            if waste:
                most = min(most, (self.allowed - wasted) // waste)
            for times in range(most, 0, -1):
                self.step()
                yield times, kind, times * waste, set(done)

    def use(self, times: int, kind: tuple[int, ...]) -> None:
        for k in kind:
            n = self.left.get(k, 0) - times
            if n:
                self.left[k] = n
            else:
                del self.left[k]

    def run(self) -> Plan | None:
        """The plan; None if there is none."""
        stack = [(self.choices(0, set()), 0)]
        taken: Plan = []
        while stack:
            found, wasted = stack[-1]
            if len(taken) == len(stack):  # come back from a choice
                self.use(-taken[-1][0], taken.pop()[1])
            choice = next(found, None)
            if choice is None:
                stack.pop()
                continue
            times, kind, waste, done = choice
            self.use(times, kind)
            taken.append((times, kind))
            if not self.left:
                return taken
            stack.append((self.choices(wasted + waste, done if max(self.left) == kind[0] else set()), wasted + waste))
        return None


def sequences_of(kinds: Plan) -> int:
    return sum(t for t, _ in kinds)


def branch_and_bound(counts: dict[int, int], capacity: int, incumbent: Plan, steps: int = STEPS) -> tuple[Plan, int]:
    """(best plan found, number of sequences below which there is proved to be none).

    From the lower bound on, numbers of sequences are tried with growing strides up to the incumbent's; each has
    ``steps`` steps.
    """
    least = proved = -(-sum(k * v for k, v in counts.items()) // capacity)
    stride = 0
    while least + stride < sequences_of(incumbent):
        most = least + stride
        try:
            found = _Search(counts, capacity, most, steps).run()
        except Spent:
            least, stride = most + 1, 2 * stride + (stride == 0)
            stride = min(stride, max(sequences_of(incumbent) - 1 - least, 0))
            continue
        if found is None:
            least = proved = most + 1
        else:
            incumbent, stride = found, 0
    return incumbent, proved


def _scaled(counts: dict[int, int], capacity: int, scale: int, steps: int) -> Plan:
    """A plan for the counts divided by ``scale``, repeated, and one for what is left over: hot lengths need few choices."""
    out: Plan = []
    for times, part in ((scale, {k: v // scale for k, v in counts.items()}), (1, {k: v % scale for k, v in counts.items()})):
        own = {k: v for k, v in part.items() if v}
        incumbent = min(best_fit(own, capacity), complete_bins(own, capacity), key=sequences_of)
        out += [(times * t, kind) for t, kind in branch_and_bound(own, capacity, incumbent, steps)[0]]
    return out


def plan(counts: dict[int, int], capacity: int, steps: int = STEPS) -> Plan:
    """A plan with the fewest sequences, or the best one that ``steps`` steps of the search for each number found."""
    incumbent = best_fit(counts, capacity)
    least = -(-sum(k * v for k, v in counts.items()) // capacity)
    if sequences_of(incumbent) > least:
        incumbent = min(incumbent, complete_bins(counts, capacity), key=sequences_of)
    top = max(counts.values(), default=0)
    for scale in sorted({math.gcd(*counts.values()), top, top // 2, top // 4} - {0, 1}):
        if sequences_of(incumbent) > least:
            incumbent = min(incumbent, _scaled(counts, capacity, scale, steps // 10), key=sequences_of)
    return branch_and_bound(counts, capacity, incumbent, steps)[0]


def _intervals(kinds: Plan) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, by their number: sorted (length, first number) with sequence, slots and offset."""
    rows, used, sequence = [], {}, 0
    for times, kind in kinds:
        offset = 0
        for length in dict.fromkeys(kind):
            m = kind.count(length)
            first = used.get(length, 0)
            rows.append((length, first, sequence, m, offset))
            used[length] = first + m * times
            offset += m * length
        sequence += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(len(rows), 5)
    return {"key": (a[:, 0] << 44) + a[:, 1], "first": a[:, 1], "sequence": a[:, 2], "slots": a[:, 3], "offset": a[:, 4]}


def place(found: DataFrame, capacity: int = 2048) -> DataFrame:
    """``found`` with sequence_id and offset; it has doc_id, piece and length.

    ``found`` is read three times and must give the same rows each time.
    """
    n = found.count()
    parts = int(min(max(PARTS[0], -(-n // PIECES_PER_PART)), PARTS[1]))
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
    salted = found.withColumn("_part", part)
    sizes = np.zeros((capacity + 1, parts), np.int64)
    # capacity * parts rows at most
    for r in salted.groupBy("length", "_part").count().collect():
        sizes[r["length"], r["_part"]] = r["count"]
    base = np.cumsum(sizes, axis=1) - sizes
    total = sizes.sum(axis=1)
    to = _intervals(plan({k: int(total[k]) for k in range(1, capacity + 1) if total[k]}, capacity))
    names = found.columns
    at = {k: i for i, k in enumerate([*names, "_part", "_number"])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, own, number = (batch.column(at[k]).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("length", "_part", "_number"))
            rank = base[length, own] + number - 1
            i = np.searchsorted(to["key"], (length << 44) + rank, side="right") - 1
            turn, slot = np.divmod(rank - to["first"][i], to["slots"][i])
            more = [pa.array(to["sequence"][i] + turn, pa.int64()), pa.array(to["offset"][i] + slot * length, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *more], names=[*names, "sequence_id", "offset"])

    numbered = salted.withColumn("_number", F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return numbered.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """All documents (doc_id, text) packed: one row per piece with sequence_id and offset.

    A null text is packed as an empty one (its end id alone); repeated rows are
    packed each; no documents give no rows.
    """
    return place(stage(pieces(docs, path, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of the whole sequence, of what :func:`pack` gave with ``keep_ids``."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(own.alias("p")).select("sequence_id", F.array_join(F.transform("p", lambda p: F.hex(p["ids"])), "").alias("h")).select("sequence_id", F.unhex("h").alias("ids"))
