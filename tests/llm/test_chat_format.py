"""Chat formatting: exact round trip, budgets, loss masks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from shopshift.llm import chat_format as C

HARD = [
    (1, 0, "system", "sys\\0 <|x"), (1, 1, "user", "a<|im_end|>\\1\n b"), (1, 2, "assistant", "x" * 50), (1, 3, "us\ner", None),
    (1, 4, "assistant", "<"), (1, 5, None, "|>\\"), (1, 6, "assistant", "é" * 100), (2, 0, "assistant", ""), (None, 0, "user", "q"),
    (None, None, "assistant", "z"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "system", "alone"), (5, 0, "user", "<|im_start|>assistant\nno"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs, out = {}, {}
    for c, t, r, x in sorted(rows, key=lambda q: (str(q[0]), q[1] is not None, q[1] or 0, q[2] or "", q[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    for c, turns in convs.items():
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget", [(10, 5), (30, 10), (60, 20), (1000, 100)])
def test_round_trip(spark, budget):
    windows = C.format_windows(spark.createDataFrame(HARD, SCHEMA), *budget)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(windows).collect()}
    assert got == expected(HARD)


def test_budget_history_and_system_turn(spark):
    rows = [(1, 0, "system", "s" * 40)] + [(1, i, "user" if i % 2 else "assistant", "t" * 36) for i in range(1, 30)]
    windows = C.format_windows(spark.createDataFrame(rows, SCHEMA), 100, 30).orderBy("window").collect()
    assert len(windows) > 3
    for i, w in enumerate(windows):
        parts = w.formatted.split(C.START)[1:]
        assert parts[0].startswith("system\n")
        assert sum(-(-len(p.split("\n", 1)[1].removesuffix(C.END + "\n")) // 4) + C.MARKS for p in parts) <= 100
        # the system turn, and two turns of 13 tokens if the window before has as many of its own
        assert w.n_context == (0 if i == 0 else 1 + min(2, own))
        own = len(parts) - (w.n_context or 1)
        texts = [w.formatted[s.start : s.start + s.length] for s in w.loss_spans]
        assert all(t == "t" * 36 for t in texts) and len(texts) == sum(p.startswith("assistant") for p in parts[w.n_context :])


def test_empty_long_and_extra_columns(spark):
    df = spark.createDataFrame(HARD, SCHEMA).withColumn("window", F.lit("w")).withColumn("tokens", F.lit(1))
    assert C.digests(C.format_windows(df)).count() == 6
    assert C.digests(C.format_windows(df.limit(0))).count() == 0
    long = spark.createDataFrame([(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "<|" * 100_000)], SCHEMA)
    r = C.digests(C.format_windows(long)).first()
    assert (r.n_turns, r.loss_chars) == (2, 200_000)


def test_a_conversation_of_very_many_turns(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text"),
    )
    r = C.digests(C.format_windows(rows)).first()
    loss = "".join(f"turn {i}" for i in range(1, n, 2))
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (n, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    plan = C.format_windows(rows)._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedfollowing" not in plan  # every frame runs once over the conversation
