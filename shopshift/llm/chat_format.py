"""Chat formatting in budgeted windows, with loss masks.  DataFrame functions only.

Prefix sums of turn tokens cut a conversation into turn-aligned spans.  A window
holds the system turn, the last turns of the window before (as many as the
history budget allows, masked) and its own turns; an assistant turn is a target
in the window it belongs to and masked wherever it is repeated.

The template marks turns with control strings.  Inside roles and texts they are
escaped: a backslash becomes ``\\0``, the bar of ``<|`` becomes ``\\1``, a line
feed in a role ``\\2``; undoing these in the opposite order gives the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET, SYSTEM = "assistant", "system"
#: Tokens of a turn's marks.
MARKS = 4
MAX_TOKENS, HISTORY_TOKENS = 1024, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\1"), F.lit("|")), F.lit("\\2"), F.lit("\n")), F.lit("\\0"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """About four bytes a token, and the marks."""
    return (F.ceil(F.octet_length(text) / 4) + MARKS).cast("long")


def format_windows(conversations: DataFrame, max_tokens: int = MAX_TOKENS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """Windows of every conversation (conv_id, turn, role, text).

    Returns conv_id, window (ascending in the conversation, with gaps),
    formatted, n_context (how many turns at its start are the system turn and
    repeated history) and loss_spans (start and length, in code points from 0,
    of the escaped target texts).

    Only a first turn of role system is the system turn.  A window exceeds
    ``max_tokens`` only by a turn that is too long by itself, as no turn is cut.
    Null roles and texts are empty; a null conv_id is one conversation; rows of
    the same turn are ordered by role and text, repeated rows are turns each.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .withColumn("pos", F.row_number().over(order))
        .withColumn("is_system", (F.col("pos") == 1) & (F.col("role") == SYSTEM))
        .withColumn("tokens", turn_tokens(F.col("text")))
        .withColumn("spoken", F.when(F.col("is_system"), 0).otherwise(F.col("tokens")))
        .withColumn("upto", F.sum("spoken").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("upto") - F.col("spoken"))
        .withColumn("system_tokens", F.first(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(order))
    )
    stride = F.greatest(F.lit(max_tokens - history_tokens) - F.col("system_tokens"), F.lit(1))
    first = F.floor(F.col("before") / stride)
    # a turn that reaches over the border of two spans gets a window of its own
    crosses = F.floor((F.greatest(F.col("upto"), F.col("before") + 1) - 1) / stride) > first
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\2")), F.lit("\n"))
    body = escape(F.col("text"))
    # from the conversation's end: the first turn of the window that comes next, in one pass
    later = conv.orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        turns.withColumn("window", F.when(F.col("is_system"), F.lit(0)).otherwise(2 * first + crosses.cast("long")).cast("long"))
        .withColumn("first_of_window", F.coalesce(F.lag("window").over(order) != F.col("window"), F.lit(True)))
        .withColumn("next", F.last(F.when(F.col("first_of_window"), F.struct("window", "before")), ignorenulls=True).over(later))
        .withColumn("next_window", F.col("next.window"))
        .withColumn("next_before", F.col("next.before"))
        .withColumn("head", head)
        .withColumn("body", body)
        .withColumn("opening", F.first(F.when(F.col("is_system"), F.struct("pos", "head", "body"))).over(order))
    )
    again = (F.col("next_before") - F.col("before") <= history_tokens) & ~F.col("is_system")
    places = F.array(
        F.struct(F.col("window").alias("w"), F.lit(False).alias("again")),
        F.when(again, F.struct(F.col("next_window").alias("w"), F.lit(True).alias("again"))),
    )
    opening = F.when(F.col("first_of_window") & (F.col("pos") > 1) & ~F.col("p.again"), F.col("opening"))
    rows = placed.withColumn("p", F.explode(F.filter(places, lambda x: x.isNotNull()))).select(
        "conv_id", F.col("p.w").alias("window"), opening.alias("opening"),
        F.struct("pos", F.col("p.again").alias("again"), (F.col("role") == TARGET).alias("target"), "head", "body").alias("t"),
    )
    # the turns of one window: bounded by its tokens
    grouped = rows.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("t")).alias("t"), F.first("opening", ignorenulls=True).alias("o"))
    system = F.col("o").isNotNull() & (F.col("t")[0]["pos"] > 1)
    prefix = F.when(system, F.concat(F.col("o.head"), F.col("o.body"), F.lit(END + "\n"))).otherwise("")
    formatted = F.concat(prefix, F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), ""))
    tail = len(END) + 1
    spans = F.aggregate(
        F.col("t"),
        F.struct(F.length(prefix).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + tail).cast("long").alias("at"),
            F.when(
                t["target"] & ~t["again"],
                F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(t["head"])).cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length")))),
            ).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    context = system.cast("int") + F.size(F.filter("t", lambda t: t["again"]))
    return grouped.select("conv_id", "window", formatted.alias("formatted"), context.alias("n_context"), spans.alias("loss_spans"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text) that are new in the window, and loss_texts, from the formatted strings."""
    parts = F.slice(
        F.split("formatted", START.replace("|", r"\|"), -1), F.col("n_context") + 2, F.greatest(F.size(F.split("formatted", START.replace("|", r"\|"), -1)) - F.col("n_context") - 1, F.lit(0))
    )
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(p.substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 2 - len(END))).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select("conv_id", "window", F.length("formatted").alias("formatted_chars"), turns.alias("turns"), loss.alias("loss_texts"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, what its windows say: turns, loss texts and size.

    The digests are of a whole conversation, so its turns meet in one row.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    own = read_back(windows).select(
        "conv_id", "formatted_chars", F.size("turns").alias("n"),
        F.struct("window", said.alias("said"), F.array_join("loss_texts", "").alias("loss")).alias("w"),
    )
    whole = own.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"), F.array_sort(F.collect_list("w")).alias("w"))
    said, loss = F.array_join("w.said", ""), F.array_join("w.loss", "")
    return whole.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
