"""Brute-force versions of the operators, for small tables."""

import re
import zlib
from collections import Counter

SF = "/root/testdata/sf0.001"


def word_list(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(text, n=5):
    w = word_list(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def classes(docs, similarity=0.8):
    """docs: (doc_id, text) -> {doc_id: (class_id, links)}."""
    sets = [(i, grams(t)) for i, t in docs]
    root, links = {i: i for i, _ in sets}, Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and both >= similarity * (len(s) + len(t) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: (find(i), links[i]) for i, _ in sets}


def contained(docs, items):
    norm = [(k, " " + " ".join(word_list(t)) + " ") for k, t in items]
    return {(i, k) for i, t in docs for d in [" " + " ".join(word_list(t)) + " "] for k, x in norm if len(x) > 2 and x in d}


SECRET = re.compile(r"AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}|(?<=PASSWORD=)[0-9A-F]{18}|(?<=TOKEN = \")[0-9A-F]{40}")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
