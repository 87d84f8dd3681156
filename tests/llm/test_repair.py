"""Cheapest repairs against a plain search over whole audits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shopshift.llm import repair as R
from tests.llm.helpers import SF

LEGAL = re.compile(r"(s?(ua)+)?")


def plain_fault(role, text, before):
    if not re.search(r"[^\x20\x09-\x0D]", text):
        return "blank"
    if (role, text) in before:
        return "duplicate"
    return "" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated"


def plain(rows):
    """rows: (turn, role, text) in order -> all results; keeps the best audit of every string of initials' end."""
    faults, seen = [], []
    for _, role, text in rows:
        faults.append(plain_fault(role, text, seen))
        seen.append((role, text))

    def insert(best):
        out = dict(best)
        for _ in range(3):
            for (state, (cost, audit, said)) in list(out.items()):
                for role in ("user", "assistant"):
                    after = {("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, role[0]))
                    if after:
                        new = (cost + 3, audit + "I", said + (f"{role}:",))
                        if after not in out or new[:2] < out[after][:2]:
                            out[after] = new
        return out

    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        out = {}
        for state, (cost, audit, said) in insert(best).items():
            ways = [(state, cost + 4, audit + "D", said)]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                for new, letter, price in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    after = step.get((state, new[:1]))
                    if after:
                        ways.append((after, cost + price + more, audit + letter, said + (f"{new}:{text}",)))
            for after, *way in ways:
                if after not in out or tuple(way[:2]) < out[after][:2]:
                    out[after] = tuple(way)
        best = out
    ends = [v for k, v in insert(best).items() if k in ("", "a")]
    cost, audit, said = min(ends, key=lambda v: v[:2])
    assert LEGAL.fullmatch("".join(x[0] for x in said))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


def random_rows(rng, n):
    return [(rng.randint(0, 2 * n), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["One.", "two", " ", "Three! ", "four?\n", "", f"{rng.random()}."])) for _ in range(n)]


def through_pieces(rows, size):
    faults, before = [], []
    for _, role, text in rows:
        faults.append(R.fault(text, (role, text) in before))
        before.append((role, text))
    turns = [(role[:1], f, 0) for (_, role, _), f in zip(rows, faults, strict=True)]
    best = {R.START: (0, R.Node("", None))}
    for i in range(0, len(turns), size):
        best = R.step(best, R.piece_ways(turns[i : i + size]))
    cost, node = R.finish(best)
    return cost, "".join(R.letters_to(node))[:-1]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_audits_are_the_least_of_the_cheapest(size):
    rng = random.Random(size)
    for _ in range(400):
        rows = sorted(random_rows(rng, rng.randint(0, 12)), key=lambda r: r[0])
        assert through_pieces(rows, size) == plain(rows)[5:7], rows


def test_equal_hashes_are_checked(monkeypatch):
    monkeypatch.setattr(R, "hash_of", lambda letters: 1)
    rng = random.Random(5)
    for _ in range(300):
        rows = sorted(random_rows(rng, rng.randint(0, 10)), key=lambda r: r[0])
        assert through_pieces(rows, 4) == plain(rows)[5:7], rows


def test_first_difference_climbs_past_common_rows():
    a = b = R.Node("", None)
    for k in range(1000):
        a, b = R.Node("K", a), R.Node("D" if k == 417 else "K", b)
    assert R.first_difference(a, b) == ("K", "D") and R.less(b, a) and not R.less(a, b) and R.first_difference(a, a) is None


def table(frame):
    return {r[0]: tuple(r)[1:] for r in frame.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: plain(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))) for c, own in out.items()}


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def test_test_table(spark):
    found = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in found.select("conv_id", "turn", "role", "text").collect()]
    want = {c: plain([]) for c, *_ in rows} | grouped(damaged(rows))
    assert table(R.damaged_and_repaired(found)) == want


def test_conversations_over_many_pieces_and_tasks(spark):
    rng = random.Random(3)
    rows = [(c, *r) for c, n in ((1, 300), (2, 1), (None, 120), (3, 40)) for r in random_rows(rng, n)]
    rows += [(4, None, None, None), (4, 1, "user", "x" * 200_000 + "."), (5, 7, "user", "Same.")] + [(6, 0, "user", "Same.")] * 50 + [(7, t, "user", "Same.") for t in range(90)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copies", F.lit("mine")).withColumn("part", F.lit(0))
    want = grouped(rows)
    assert table(R.repair(frame.repartition(5))) == want
    assert table(R.repair(frame.repartition(3), piece_rows=7)) == want


def test_lost_and_empty_conversations(spark):
    # crc32("3:17") and the like: every row of a conversation may be dropped
    dropped = [(c, t) for c in range(200) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    frame = spark.createDataFrame([(c, t, "user", "Hi.") for c, t in dropped], "conv_id long, turn long, role string, text string")
    got = table(R.damaged_and_repaired(frame))
    assert set(got) == {c for c, _ in dropped} and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert table(R.damaged_and_repaired(frame.limit(0))) == {}
