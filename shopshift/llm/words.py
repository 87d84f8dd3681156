"""Words of many texts at once, as numpy arrays.

A word is a run of ASCII letters and digits and of other characters that are no
punctuation or white space; case is folded.  Words are hashed to 64 bits, so a
pass over the bytes replaces a loop over the words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of text handled at a time.  The arrays beside them take some fifty times as much, in every Python worker.
CHUNK_BYTES = 1 << 18

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.multiply.accumulate(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))
_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: First bytes of cased letters outside ASCII and Latin-1.
_OTHER_CASED = re.compile("[Ā-ɏͰ-֏Ⴀ-ჿᲀ-῿Ⰰ-ⷿꙀ-ꟿꬰ-ꮿＡ-ｚ]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of ``n_texts`` texts in order: hash, text, first and one past last byte, and the folded and upper-case bytes."""

    n_texts: int
    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    raw: np.ndarray
    upper: np.ndarray

    def bounds(self) -> np.ndarray:
        """The words of text i are those from bounds[i] to bounds[i + 1]."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))


def words(texts: list[str]) -> Words:
    """The words of ``texts``."""
    data = [(t if t.isascii() or not _OTHER_CASED.search(t) else t.lower()).encode() for t in texts]
    size = np.array([len(t) + 1 for t in data], np.int64)
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)  # a separator after each text
    n = len(raw)
    before = np.empty_like(raw)
    before[0], before[1:] = 0, raw[:-1]
    upper = (raw >= 65) & (raw <= 90)
    latin = (before == 0xC3) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    folded = raw + np.uint8(32) * (upper | latin)
    upper[:-1] |= latin[1:]
    part = _ASCII_WORD[raw]
    # punctuation and signs: U+0080 to U+00BF, U+2000 to U+207F, U+3000 to U+303F
    lead = np.flatnonzero((raw == 0xC2) | (raw == 0xE2) | (raw == 0xE3))
    if len(lead):
        after = raw[np.minimum(lead + 1, n - 1)]
        two = lead[raw[lead] == 0xC2]
        part[two] = part[two + 1] = False
        three = lead[(raw[lead] == 0xE2) & ((after == 0x80) | (after == 0x81)) | (raw[lead] == 0xE3) & (after == 0x80)]
        part[three] = part[three + 1] = part[three + 2] = False
    edge = np.empty(n, bool)
    edge[0], edge[1:] = part[0], part[1:] & ~part[:-1]
    start = np.flatnonzero(edge)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(len(texts), np.zeros(0, np.uint64), none, none, none, raw, upper)
    own = np.diff(np.append(start, n))
    value = _BYTE[folded] * _POWER[(np.arange(start[0], n) - np.repeat(start, own)) & 0xFFFF] if start[0] == 0 else None
    if value is None:
        value = _BYTE[folded[start[0] :]] * _POWER[(np.arange(start[0], n) - np.repeat(start, own)) & 0xFFFF]
    value *= part[start[0] :]
    rel = start - start[0]
    length = np.add.reduceat(part[start[0] :].astype(np.int64), rel)
    text = np.searchsorted(np.cumsum(size), start, side="right")
    return Words(len(texts), mix(np.add.reduceat(value, rel) + length.astype(np.uint64)), text, start, start + length, raw, upper)


def chunks(texts: Iterable[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of pieces of about ``limit`` characters; a longer text is a piece by itself."""
    held: list[str] = []
    size = first = 0
    for text in texts:
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = first + len(held), [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def word_hash(word: str) -> np.uint64:
    """The hash that :func:`words` gives ``word``."""
    return words([word]).hash[0]


def shingles(own: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``n`` words; a text of fewer words has one of all its words, one of none has none."""
    h, m = own.hash, len(own.hash)
    if not m:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = max(m - n + 1, 0)
    acc = np.zeros(whole, np.uint64)
    for k in range(n):
        acc += h[k : k + whole] * _POWER[k + 1]
    fits = own.text[:whole] == own.text[n - 1 : n - 1 + whole]
    out, text = mix(acc[fits]), own.text[:whole][fits]
    bounds = own.bounds()
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        extra = np.array([np.bitwise_xor.reduce(h[bounds[i] : bounds[i + 1]] * _POWER[1 : size[i] + 1] + np.uint64(size[i])) for i in short], np.uint64)
        out, text = np.concatenate([out, mix(extra)]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        out, text = out[order], text[order]
    return out, text
