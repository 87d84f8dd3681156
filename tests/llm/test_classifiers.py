"""Quality and language: held-out accuracy, null and empty texts, missing classes."""

import numpy as np
from pyspark.sql import functions as F

from shopshift.llm import langid, quality
from shopshift.llm.queries import _held_out
from tests.llm.helpers import crc

TABLES = "/root/testdata/sf0.01"
EDGE = [(1, None), (2, ""), (3, "123 ..."), (4, "the and of " * 100_000), (None, "x"), (5, "y"), (5, "y")]


def test_held_out_rows(spark):
    ids = [0, 1, -7, 41, 10**12, None, *range(100, 160)]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", _held_out(3, 1).alias("a"), _held_out(4, 2).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(i is not None and crc(i) % 3 == 1, i is not None and crc(i) % 4 == 2) for i in ids]


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    assert {r.doc_id for r in docs.filter(_held_out(3, 1)).collect()} == {r.doc_id for r in docs.collect() if crc(r.doc_id) % 3 == 1}
    model = quality.fit(docs, labels.filter(~_held_out(3, 1)).select("doc_id", F.col("quality").alias("label")))
    rows = quality.score(docs, model, ["doc_id"]).join(labels.filter(_held_out(3, 1)), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == y] for y in (1, 0))
    assert len(good) > 50 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("label", F.lit(0)).withColumn("h", F.lit("h"))
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (None, 1), (2, None)], "doc_id long, label int")
    model = quality.fit(docs, labels)  # one class only: the prior
    rows = quality.score(docs, model, docs.columns).collect()
    assert len(rows) == len(EDGE) and {r.score for r in rows} == {model.prior} and 0 < model.prior < 1
    both = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, label int"))
    assert all(0 <= r.score <= 1 for r in quality.score(docs, both, ["doc_id"]).collect())
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0)), ["doc_id"]).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = langid.fit(docs.filter(~_held_out(4, 2)))
    rows = langid.predict(docs.filter(_held_out(4, 2)), model, ["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("lang", F.lit("en"))
    model = langid.fit(docs.unionByName(docs.withColumn("text", F.lit("und der die das")).withColumn("lang", F.lit("de"))))
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model, ["doc_id"]).collect()]
    assert len(got) == len(EDGE)
    assert {(i, p, s) for i, p, s in got if i in (1, 2, 3)} == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    assert {p for i, p, _ in got if i == 4} == {"en"}
    assert langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def test_network_agrees_with_plain_convolution():
    model = langid.new_model(["a", "b"], seed=3)
    x = np.random.default_rng(1).integers(0, 256, (3, 40)).astype(np.uint8)
    pooled = []
    for w, table in zip(langid.WIDTHS, model.tables, strict=True):
        pooled.append([[max(sum(table[k][row[i + k]][f] for k in range(w)) for i in range(40 - w + 1)) for f in range(langid.FILTERS)] for row in x])
    want = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense + model.dense_bias
    assert np.allclose(langid.logits(model, x), want, atol=1e-4)


def test_whole_text_takes_part():
    model = langid.new_model(["a", "b"], seed=5)
    text = "x" * 1000
    assert langid.predict_texts(model, [text])[1] != langid.predict_texts(model, [text[:-300] + "q" * 300])[1]
    alone = [langid.predict_texts(model, [t])[1][0] for t in ("abc", text, "z" * 700)]
    assert np.allclose(langid.predict_texts(model, ["abc", text, "z" * 700])[1], alone)


def test_kept_columns_called_like_results(spark):
    docs = spark.createDataFrame([(1, "und der die das", "x", 5)], "doc_id long, text string, Score string, lang_pred int")
    model = langid.new_model(["a", "b"], seed=5)
    out = langid.predict(docs, model, ["doc_id", "Score", "lang_pred"])
    assert out.columns == ["doc_id", "kept_Score", "kept_lang_pred", "lang_pred", "score"]
    assert tuple(out.first())[:3] == (1, "x", 5) and 0 <= out.select("score").first()[0] <= 1
    labels = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    scored = quality.score(docs, quality.fit(docs, labels), ["doc_id", "Score", "lang_pred"])
    assert scored.columns == ["doc_id", "kept_Score", "lang_pred", "score"] and 0 <= scored.select("score").first()[0] <= 1


def test_a_repeated_id_gives_one_row_to_learn_from(spark):
    rows = [(1, f"ein text {i} der viele male da ist", "de") for i in range(300)] + [(2, "one text", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []

    def counted(x, y, languages):
        seen.append(len(x))
        return langid.new_model(languages, seed=1)

    train, langid.train = langid.train, counted
    try:
        langid.fit(docs)
    finally:
        langid.train = train
    assert seen[0] <= 2 * langid.WINDOWS_PER_DOC
