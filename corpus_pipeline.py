"""Corpus preparation: quality, near duplicates, benchmark passages, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which :func:`run` writes as Parquet and reads again as the
next one's ``docs``.  All but the last return the columns of ``docs``; a null
text counts as empty and rows with null ids are kept or dropped like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopshift.llm import decontam, ngram_join, packing, quality, queries, secret_scan
from shopshift.llm.common import fresh_name, prepare, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more; learned from the labels that are not held out."""
    prepare(spark)
    # the model's name for its result must not meet a column of docs
    clash = [c for c in docs.columns if c.lower() in ("score", "_scored")]
    safe = {c: fresh_name(docs, f"kept_{c}") for c in clash}
    renamed = docs.withColumnsRenamed(safe)
    scored = quality.score(renamed, queries.quality_model(spark, sf_dir, renamed), renamed.columns)
    return scored.filter("score >= 0.5").drop("score").withColumnsRenamed({v: k for k, v in safe.items()})


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by 5-gram similarities of 0.8 or more."""
    prepare(spark)
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    prepare(spark)
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    prepare(spark)
    own = docs.select("doc_id", "text", *[c for c in docs.columns if c.lower() == "source"])
    return secret_scan.redact(docs, secret_scan.scan(own, own.columns[2] if len(own.columns) > 2 else None))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack(docs.select("doc_id", "text"), queries.tokenizer_path(), 2048, 0)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: Not expressible in SQL (compression, MinHash, a trained forest, a tokenizer); tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
