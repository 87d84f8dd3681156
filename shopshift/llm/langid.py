"""Language identification by a byte convolutional network in numpy.

Lower-cased UTF-8 text is cut into windows of ``WINDOW`` bytes (the last padded
with zeros).  Filters of several widths run over the bytes, each filter's
maximum over the window is kept, and a softmax layer gives the languages.  A
text's prediction is the softmax of its windows' mean logits, weighted by their
bytes, so every byte of the text takes part.

A filter's weights for a byte at an offset stand in a table of 256 rows, so a
convolution is a sum of table look-ups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import kept_columns

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Labelled texts that the network is trained on (chosen by a hash of the id), windows of each, and passes.
TRAIN_DOCS = 4000
WINDOWS_PER_DOC = 2
EPOCHS = 12
#: Windows that are convolved at a time.
BATCH = 128
UNKNOWN = "und"


@dataclass
class LangModel:
    """``tables[w][k]``: 256 x FILTERS weights of width ``WIDTHS[w]`` at offset k."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray


def new_model(languages: list[str], seed: int = 7) -> LangModel:
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    for t in tables:
        t[:, 0] = 0  # the padding
    n = len(WIDTHS) * FILTERS
    dense = rng.normal(0, 0.2, (n, len(languages))).astype(np.float32)
    return LangModel(languages, tables, np.zeros(n, np.float32), dense, np.zeros(len(languages), np.float32))


def _convolve(model: LangModel, x: np.ndarray) -> list[np.ndarray]:
    """Per width, the responses (windows, positions, filters) to the byte matrix ``x``."""
    out = []
    for w, table in zip(WIDTHS, model.tables, strict=True):
        n = x.shape[1] - w + 1
        acc = np.take(table[0], x[:, :n], axis=0)
        for k in range(1, w):
            acc += np.take(table[k], x[:, k : k + n], axis=0)
        out.append(acc)
    return out


def logits(model: LangModel, x: np.ndarray) -> np.ndarray:
    """Logits of every window of the byte matrix ``x``."""
    out = np.empty((len(x), len(model.languages)), np.float32)
    for s in range(0, len(x), BATCH):
        pooled = np.concatenate([a.max(axis=1) for a in _convolve(model, x[s : s + BATCH])], axis=1)
        out[s : s + BATCH] = np.maximum(pooled + model.bias, 0) @ model.dense + model.dense_bias
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> LangModel:
    """Adam on the cross entropy; every pass crops each window to a new length so that short texts are learned too."""
    model, rng = new_model(languages, seed), np.random.default_rng(seed)
    params = [*model.tables, model.bias, model.dense, model.dense_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(order), 64):
            rows = order[s : s + 64]
            xb, yb = x[rows].copy(), y[rows]
            cut = np.where(rng.random(len(rows)) < 0.4, rng.integers(8, x.shape[1] + 1, len(rows)), x.shape[1])
            xb[np.arange(x.shape[1])[None, :] >= cut[:, None]] = 0
            conv = _convolve(model, xb)
            where = [a.argmax(axis=1) for a in conv]
            pooled = np.concatenate([np.take_along_axis(a, p[:, None, :], 1)[:, 0] for a, p in zip(conv, where, strict=True)], axis=1)
            act = np.maximum(pooled + model.bias, 0)
            z = _softmax(act @ model.dense + model.dense_bias)
            z[np.arange(len(yb)), yb] -= 1
            z /= len(yb)
            back = (z @ model.dense.T) * (act > 0)
            grads = []
            for i, (w, p) in enumerate(zip(WIDTHS, where, strict=True)):
                g, own = np.zeros_like(model.tables[i]), back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[k], (np.take_along_axis(xb, p + k, 1), np.arange(FILTERS)[None, :]), own)
                g[:, 0] = 0
                grads.append(g)
            grads += [back.sum(axis=0), act.T @ z, z.sum(axis=0)]
            step += 1
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def windows(text: str) -> np.ndarray:
    """The byte matrix of a lower-cased text; at least one window."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(data)] = data
    return out


def fit(docs: DataFrame) -> LangModel | None:
    """Train on ``docs`` (doc_id, text, lang): a sample of ``TRAIN_DOCS`` ids by a hash, with one text of each in a language.

    Rows with a null text or language are left out; of a repeated id (null is one) the smallest text of each language is taken.  None if no row is left.
    """
    rows = (
        docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
        .select(F.xxhash64("doc_id", F.lit(7)).alias("h"), "doc_id", "lang", F.lower("text").alias("text"))
    )
    # ids, so that a repeated one counts once
    chosen = rows.select("h").distinct().orderBy("h").limit(TRAIN_DOCS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = windows(text)
                for i in range(min(WINDOWS_PER_DOC, len(own))):
                    out.append((h, lang, own[zlib.crc32(b"%d %d" % (h, i)) % len(own)].tobytes()))
            h, lang, window = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(lang, pa.string()), pa.array(window, pa.binary())], names=["h", "lang", "window"])

    # TRAIN_DOCS hashes, and one text of each in a language
    one_each = rows.join(F.broadcast(chosen), "h").groupBy("h", "lang").agg(F.min("text").alias("text"))
    sample = one_each.select("h", "lang", "text").mapInArrow(cut, "h long, lang string, window binary").collect()
    if not sample:
        return None
    sample = sorted((r.h, r.lang, bytes(r.window)) for r in sample)
    languages = sorted({lang for _, lang, _ in sample})
    x = np.frombuffer(b"".join(w for *_, w in sample), np.uint8).reshape(len(sample), WINDOW)
    return train(x, np.array([languages.index(lang) for _, lang, _ in sample]), languages)


def predict_texts(model: LangModel, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages and probabilities of lower-cased texts."""
    sizes = np.array([max(1, len(t.encode())) for t in texts])
    each = -(-sizes // WINDOW)
    z = np.empty((len(texts), len(model.languages)))
    at = 0
    while at < len(texts):  # texts of about BATCH windows together
        end = max(at + 1, int(np.searchsorted(np.cumsum(each[at:]), 4 * BATCH)) + at)
        own = logits(model, np.concatenate([windows(t) for t in texts[at:end]])).astype(np.float64)
        weight = np.full(each[at:end].sum(), float(WINDOW))
        last = np.cumsum(each[at:end]) - 1
        weight[last] = sizes[at:end] - (each[at:end] - 1) * WINDOW
        z[at:end] = np.add.reduceat(own * weight[:, None], last + 1 - each[at:end], axis=0) / sizes[at:end, None]
        at = end
    p = _softmax(z) if len(texts) else z
    best = p.argmax(axis=1) if len(texts) else np.zeros(0, int)
    return [model.languages[i] for i in best], p[np.arange(len(texts)), best]


def predict(docs: DataFrame, model: LangModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (the probability of that language) for the whole text.

    A null text, one without any letter, or a model that learned from nothing
    gives ``und`` with score 0.  Repeated rows are predicted each.  A kept
    column called like a result comes back as ``kept_<name>``.
    """
    kept = docs.select(*kept_columns(docs, keep, ["lang_pred", "score"]))
    own = F.col(text_col)
    text = F.when(own.rlike(r"\p{L}"), F.lower(own))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n).to_pylist()
            said = [i for i, t in enumerate(texts) if t is not None] if model else []
            names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if said:
                found, p = predict_texts(model, [texts[i] for i in said])
                score[said] = p
                for i, name in zip(said, found, strict=True):
                    names[i] = name
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(names, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names[:n], "lang_pred", "score"])

    return docs.select(*kept_columns(docs, keep, ["lang_pred", "score"]), text.alias("_predicted")).mapInArrow(run, f"{fields}, lang_pred string, score double")
