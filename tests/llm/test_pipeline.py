"""The registered queries and the pipeline, stage by stage, against brute force."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from shopshift.llm import packing, quality, queries
from shopshift.llm.common import stage
from tests.llm.helpers import SECRET, SF, classes, contained
from tests.llm.test_packing import check_sequences

COLUMNS = {
    "op1": ["page_id", "url", "text", "n_chars"],
    "op4": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op5": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7": ["doc_id", "held_out", "lang_pred", "score"],
    "op8": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9": ["doc_id", "held_out", "score", "predicted"],
    "op10": ["query_id", "rank", "vec_id", "score"],
}


def test_one_query_for_each_operator():
    names = [q for q in E.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op10_topk_search"])
def test_against_sql(spark, name):
    df = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(rel.fetchall())


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_columns(spark, op):
    name = next(q for q in E.queries() if q.startswith(f"{op}_"))
    assert E.queries()[name](spark, SF).columns == COLUMNS[op]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]

    def run(k, before):
        out = stage(P.STAGES[k][1](spark, before, SF), "test")
        if k < 4:
            assert out.columns == docs.columns
        return out, {r.doc_id: r.text for r in out.collect()} if k < 4 else out.collect()

    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = quality.score(docs, queries.quality_model(spark, SF, docs), ["doc_id"]).collect()
    out, kept = run(0, docs)
    assert set(kept) == {r.doc_id for r in scores if r.score >= 0.5}
    want = {i for i, (c, _) in classes(sorted(kept.items())).items() if i == c}
    out, kept = run(1, out)
    assert set(kept) == want
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out, clean = run(2, out)
    assert set(clean) == set(kept) - {i for i, _ in contained(kept.items(), items)}
    out, redacted = run(3, out)
    assert redacted == {i: SECRET.sub("[SECRET]", t) for i, t in clean.items()}
    out, packed = run(4, out)
    check_sequences(packed, 2048)
    ids = packing.tokenizer(queries.tokenizer_path()).encode(list(redacted.values()))
    assert sum(r.length for r in packed) == sum(len(x) + 1 for x in ids)
    whole = {(r.doc_id, r.piece): r.ids_crc32 for r in P.run(spark, SF).collect()}
    assert whole == {(r.doc_id, r.piece): r.ids_crc32 for r in packed}
    assert texts.keys() >= redacted.keys()


def test_stages_on_odd_tables(spark):
    """Nulls, repeated rows, columns with the stages' own names, an empty table."""
    when = datetime.date(2020, 1, 1)
    rows = [(1, None, None, "s", 0, 1, "k", when), (2, "", "en", None, 0, 1, None, when), (None, "the words of one text", "en", "s", 1, 2, "k", None)]
    rows += [(7, "the words of a text that is here twice", None, "s", 5, 1, "k", when)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, row_key string, day date")
    docs = docs.withColumn("spans", F.lit(1)).withColumn("_scored", F.lit("x"))
    for name, fn in P.STAGES:
        out = fn(spark, docs, SF)
        if name != "best-fit packing":
            assert out.columns == docs.columns, name
        assert out.count() <= len(rows)
        empty = fn(spark, docs.limit(0), SF)
        assert empty.count() == 0, name
    assert P.STAGES[1][1](spark, docs, SF).filter("doc_id = 7").count() == 1
    assert P.STAGES[3][1](spark, docs, SF).count() == len(rows)
