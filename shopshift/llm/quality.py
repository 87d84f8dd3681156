"""Quality classifier by compression with two zstandard dictionaries.

One dictionary is built from texts labelled good, one from texts labelled bad.
A text is cut into windows, every window is compressed with either, and the
sizes are added up over the whole text.  Their normalised difference says which
dictionary knows the text better; with the compression ratio and the length it
is calibrated to a probability by logistic regression.

The fit uses a bounded sample of the labelled documents (``DICT_DOCS`` per class
for the dictionaries, ``FIT_DOCS`` others for the calibration, both chosen by a
hash of the id); scoring covers every text in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import kept_columns

WINDOW_BYTES = 4096
DICT_BYTES = 112640
LEVEL = 3
#: Labelled documents of each class, one window of each, that the dictionaries are built from.
DICT_DOCS = 2000
#: Other labelled documents that the calibration is fitted to.
FIT_DOCS = 4000


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; ``weights`` is empty if there were not two classes to fit."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


class _Sizer:
    """Compressed sizes of a text with either dictionary."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.compress = [self._compressor(d).compress for d in (good, bad)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(content)
        own.precompute_compress(LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False)

    def features(self, text: str | None) -> list[float]:
        data = (text or "").encode()
        n, (good, bad) = len(data), (
            sum(len(f(data[i : i + WINDOW_BYTES])) for i in range(0, max(len(data), 1), WINDOW_BYTES)) for f in self.compress
        )
        return [(good - bad) / (good + bad), (good - bad) / (n + 1), min(good, bad) / (n + 16), float(np.log1p(n))]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window of each text, picked by the hash that came with it."""
    for batch in batches:
        texts, labels, picks = (batch.column(i).to_pylist() for i in range(3))
        cut = []
        for text, pick in zip(texts, picks, strict=True):
            data = (text or "").encode()
            at = pick % max(1, -(-len(data) // WINDOW_BYTES)) * WINDOW_BYTES
            cut.append(data[at : at + WINDOW_BYTES])
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(picks, pa.int64()), pa.array(cut, pa.binary())], names=["label", "pick", "cut"])


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where the samples are too few to train one, they are the dictionary."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICT_BYTES:] or b"empty dictionary"


def _feature_rows(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _Sizer(good, bad)
        for batch in batches:
            rows = [sizer.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, label 0 or 1).

    Null or other labels and ids with contradicting labels are left out.
    Without labelled texts of both classes the model has only the prior.
    """
    known = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("doc_id", "label", F.xxhash64("doc_id", F.lit(9)).alias("h"))
    )
    part = F.pmod("h", F.lit(2))
    chosen = known.filter((part == 1)).orderBy("h").limit(FIT_DOCS).withColumn("role", F.lit("fit"))
    for label in (0, 1):
        chosen = chosen.unionByName(known.filter((part == 0) & (F.col("label") == label)).orderBy("h").limit(DICT_DOCS).withColumn("role", F.lit("dict")))
    # at most 2 * DICT_DOCS + FIT_DOCS ids, and one row of each: that with the smallest text
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "role").agg(F.min("text").alias("text"))
    pick = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    cuts = (
        sample.filter("role = 'dict'").select("text", "label", pick.alias("pick"))
        .mapInArrow(_windows, "label int, pick long, cut binary").collect()
    )
    cuts = sorted((r.pick, bytes(r.cut), r.label) for r in cuts)
    good, bad = (_dictionary([c for _, c, y in cuts if y == label]) for label in (1, 0))
    rows = sample.filter("role = 'fit'").select("text", "label").mapInArrow(_feature_rows(good, bad), "label int, x array<double>").collect()
    rows.sort(key=lambda r: (r.label, r.x))
    y = np.array([r.label for r in rows], float)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y)) < 2 or len({c[2] for c in cuts}) < 2:
        return QualityModel(good, bad, (), (), (), prior)
    x = np.array([r.x for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = _logistic(np.c_[(x - mean) / scale, np.ones(len(x))], y)
    return QualityModel(good, bad, tuple(mean), tuple(scale), tuple(w), prior)


def _scorer(model: QualityModel, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _Sizer(model.good, model.bad)
        for batch in batches:
            texts = batch.column(width).to_pylist()
            if model.weights:
                x = np.array([sizer.features(t) for t in texts]).reshape(len(texts), len(model.mean))
                z = np.c_[(x - np.array(model.mean)) / np.array(model.scale), np.ones(len(x))] @ np.array(model.weights)
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                score = np.full(len(texts), model.prior)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(score, pa.float64())], names=[*batch.schema.names[:width], "score"])

    return run


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``score``: the probability of label 1 for the whole text.

    A null text counts as empty; an empty text has the score that its length
    gives.  Repeated rows are scored each.  A kept column called ``score``
    comes back as ``kept_score``.
    """
    kept = kept_columns(docs, keep, ["score"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col(text_col).alias("_scored")).mapInArrow(_scorer(model, len(keep)), f"{fields}, score double")
