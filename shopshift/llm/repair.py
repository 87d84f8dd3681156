"""Cheapest repair of conversations' structure, with an audit that is the least of its ties.

* Equal rows of a conversation meet by a partial aggregate.  Rows are dealt over the
  cluster by ranges of (conversation, turn, role, text), so a long conversation lies
  in several tasks, each of which cuts what it has into pieces of bounded size.
* A repair is a path through four states: nothing said yet, a system turn said, a
  user turn said, an assistant turn said.  A piece gives, for every state before and
  after it, the least cost and the least audit of that cost.
* Audits share their prefixes as linked nodes, one node per row.  A node knows its
  ancestors 1, 2, 4, ... rows back and a rolling hash of its path.  Of two audits of
  one cost, the ancestors with different hashes are followed down to the first row
  where they part; equal hashes are checked letter by letter up to a common node.
* A second step joins the pieces of a conversation in the same way, one node per
  piece, and then reads the conversation's rows once more, in order, for the hash of
  the repaired turns: one row at a time is held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import each_salt, salt, salts

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: What a turn of the initial leads to, from each state that allows it.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: A repair that costs more than this above another can never catch up: an insertion and a deletion bring any state to any other's future.
LAG = INSERT + DELETE
#: Distinct rows of a piece.
PIECE_ROWS = 2048

SPACES = " \t\n\x0b\x0c\r"
_WORDED = re.compile(r"[^\x20\x09-\x0D]")


class Node:
    """The last step of an audit: the letters of one row (or piece), and the nodes before it."""

    __slots__ = ("letters", "up", "hash")

    def __init__(self, letters: str, parent: Node | None) -> None:
        self.letters = letters
        self.hash = 0 if parent is None else (parent.hash * 1_000_003 + hash_of(letters)) % ((1 << 61) - 1)
        self.up: list[Node] = [] if parent is None else [parent]
        k = 0
        while self.up and k < len(self.up[k].up):
            self.up.append(self.up[k].up[k])
            k += 1


@lru_cache(maxsize=4096)
def hash_of(letters: str) -> int:
    h = 7
    for c in letters:
        h = (h * 131 + ord(c)) % ((1 << 61) - 1)
    return h


def same_path(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth have equal audits, letter by letter."""
    while a is not b:
        if a.letters != b.letters:
            return False
        a, b = a.up[0], b.up[0]
    return True


def first_difference(a: Node, b: Node) -> tuple[str, str] | None:
    """The letters of the first row where two audits of one depth differ; None if they are equal."""
    if a is b or a.hash == b.hash and same_path(a, b):
        return None
    while True:
        # up to the highest ancestors with different hashes
        for k in range(len(a.up) - 1, -1, -1):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        p, q = a.up[0], b.up[0]
        if same_path(p, q):
            return a.letters, b.letters
        # equal hashes of different audits: they part further up
        a, b = p, q


def less(a: Node, b: Node) -> bool:
    """Whether the audit of ``a`` comes before that of ``b``; both have one depth and one cost.

    A row's letters end in one that is no insertion, so none is a prefix of another's.
    """
    parted = first_difference(a, b)
    return parted is not None and parted[0] < parted[1]


def fault(text: str, seen: bool) -> str:
    """blank, duplicate, truncated or nothing."""
    if not _WORDED.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return "" if text.rstrip(SPACES)[-1] in ".!?" else "truncated"


def _inserted() -> dict[tuple[int, int], str]:
    """(from, to) -> the insertions, 'I' each, that lead from one state to another."""
    out = {(s, s): "" for s in range(4)}
    for s in range(4):
        at, letters = s, ""
        for _ in range(2):
            at = USER if at in NEXT["u"] else ASSISTANT
            letters += "I"
            out.setdefault((s, at), letters)
    return out


INSERTED = _inserted()


@lru_cache(maxsize=4096)
def moves(initial: str, broken: str) -> list[tuple[int, int, str, int]]:
    """(from, to, letters, cost) of every way to handle a row, with what is inserted before it.

    Two insertions before a row, or one before a deletion, are left out: such a
    repair is dearer, or comes later, than one without.
    """
    out = [(s, s, "D", DELETE) for s in range(4)]
    if broken in ("blank", "duplicate"):
        return out
    extra = CUT_SHORT if broken == "truncated" else 0
    for (s, t), letters in INSERTED.items():
        before = INSERT * len(letters)
        if before > INSERT:
            continue
        if t in NEXT.get(initial, {}):
            out.append((s, NEXT[initial][t], letters + "K", before + extra))
        for role in "ua":
            if role != initial and t in NEXT[role]:
                out.append((s, NEXT[role][t], letters + "R", before + REROLE + extra))
    return out


def step(best: dict[int, tuple[int, Node]], ways: list[tuple[int, int, str, int]]) -> dict[int, tuple[int, Node]]:
    """The best repairs after one more row; ``best``: state -> (cost, audit)."""
    out: dict[int, tuple[int, Node]] = {}
    for s, t, letters, cost in ways:
        if s not in best:
            continue
        total = best[s][0] + cost
        if t in out and total > out[t][0]:
            continue
        node = Node(letters, best[s][1])
        if t not in out or total < out[t][0] or less(node, out[t][1]):
            out[t] = (total, node)
    least = min(c for c, _ in out.values())
    return {t: v for t, v in out.items() if v[0] <= least + LAG}


def letters_to(node: Node) -> list[str]:
    """The letters of every row of an audit, in order."""
    out = []
    while node.up:
        out.append(node.letters)
        node = node.up[0]
    return out[::-1]


def piece_ways(turns: list[tuple[str, str, int]], starts: range = range(4)) -> list[tuple[int, int, str, int]]:
    """(from, to, letters, cost) of a piece, from the given states; turns: (initial, fault, equal rows that follow)."""
    out = []
    for s in starts:
        best = {s: (0, Node("", None))}
        for initial, broken, more in turns:
            best = step(best, moves(initial, broken))
            if more:  # equal rows that follow are blank or duplicates: deleted, before anything is inserted
                best = {t: (c + DELETE * more, Node("D" * more, node)) for t, (c, node) in best.items()}
        out += [(s, t, "".join(letters_to(node)), c) for t, (c, node) in best.items()]
    return out


def finish(best: dict[int, tuple[int, Node]]) -> tuple[int, Node]:
    """The best complete repair: what is missing at the end is inserted."""
    ways = [(s, t, letters, INSERT * len(letters)) for (s, t), letters in INSERTED.items() if t in FINAL]
    out: tuple[int, Node] | None = None
    for s, _, letters, cost in ways:
        if s in best:
            total = best[s][0] + cost
            # "~" ends the letters and comes after all of them
            node = Node(letters + "~", best[s][1])
            if out is None or total < out[0] or total == out[0] and less(node, out[1]):
                out = (total, node)
    return out


class Speaker:
    """Repaired turns as a running hash."""

    def __init__(self) -> None:
        self.sha, self.state, self.first = hashlib.sha256(), START, True

    def say(self, role: str, text: str) -> None:
        self.sha.update((("" if self.first else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.first = False

    def insert(self) -> None:
        user = self.state in NEXT["u"]
        self.say("user" if user else "assistant", "")
        self.state = USER if user else ASSISTANT

    def row(self, letters: str, role: str, text: str) -> None:
        """One row with its letters (insertions, then what becomes of it)."""
        for _ in range(len(letters) - 1):
            self.insert()
        if letters[-1] == "K":
            self.say(role, text)
            self.state = NEXT[role[0]][self.state]
        elif letters[-1] == "R":
            user = self.state in NEXT["u"]
            self.say("user" if user else "assistant", text)
            self.state = USER if user else ASSISTANT


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after damage by crc32 of ``conv_id:turn``: dropped, emptied, unstopped, repeated, re-roled."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part[3], "[.!?]", "")).otherwise(part[3])
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(part[2]).alias("role"), text.alias("text"),
    ).filter("kind != 0").select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


SUMS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_PIECE = {
    "conv_id": "long", "part": "long", "place": "long", "copies": "long", "role": "string", "text": "string", "first": "string", "last": "string",
    "first_turn": "long", "low": "long", "last_turn": "long", **dict.fromkeys(SUMS, "long"), "ways": "array<struct<s:int,t:int,letters:string,cost:long>>",
}
_WAYS = pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("letters", pa.string()), ("cost", pa.int64())]))
_TYPES = [{"long": pa.int64(), "string": pa.string()}.get(t, _WAYS) for t in _PIECE.values()]
LEGAL = ("su", "ua", "au")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(_PIECE, _TYPES, strict=True)], names=list(_PIECE))


class _Piece:
    """Up to ``PIECE_ROWS`` distinct rows of one conversation that follow each other."""

    def __init__(self, conv_id: int | None, part: int, starts: range) -> None:
        self.conv_id, self.part, self.starts = conv_id, part, starts
        self.turns: list[tuple[str, str, int]] = []
        self.sums = dict.fromkeys(SUMS, 0)
        self.first = self.last = ""
        self.first_turn = self.low = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        broken, initial, sums = fault(text, seen), role[:1], self.sums
        if broken:
            sums[broken] += 1
        if copies > 1:
            sums["blank" if broken == "blank" else "duplicate"] += copies - 1
        sums["illegal"] += copies - 1 + int(bool(self.turns) and self.last + initial not in LEGAL)
        sums["turns"] += int(turn is not None and (not self.turns or turn != self.last_turn))
        if not self.turns:
            self.first, self.first_turn = initial, turn
        if self.low is None:
            self.low = turn
        self.last, self.last_turn = initial, turn
        self.turns.append((initial, broken, copies - 1))

    def row(self) -> dict:
        ways = [{"s": s, "t": t, "letters": letters, "cost": c} for s, t, letters, c in piece_ways(self.turns, self.starts)]
        own = {c: getattr(self, c) for c in ("conv_id", "part", "first", "last", "first_turn", "low", "last_turn")}
        return {**own, "place": 0, **self.sums, "ways": ways}


def _pieces(piece_rows: int):
    """Of sorted rows (conv_id, turn, role, text, copies, seen): every row (place > 0) and, per piece, its sums and ways (place 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        piece, out = None, []
        for batch in batches:
            for c, turn, role, text, copies, seen in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if piece is None or c != piece.conv_id or len(piece.turns) == piece_rows:
                    # a conversation that begins after another one in this task has nothing before it
                    begins = piece is not None and c != piece.conv_id
                    if piece is not None:
                        out.append(piece.row())
                    part += 1
                    piece = _Piece(c, part, range(1) if begins else range(4))
                piece.add(turn, role, text, copies, seen)
                out.append({"conv_id": c, "part": part, "place": len(piece.turns), "copies": copies, "role": role, "text": text})
                if len(out) >= 500:
                    yield _batch(out)
                    out = []
        if piece is not None:
            out.append(piece.row())
            yield _batch(out)

    return run


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_OUT = "conv_id long, " + ", ".join(f"{c} long" for c in _RESULT) + ", audit string, repaired_sha256 string"


class _Conversation:
    """One conversation: its pieces' sums and ways first, then its rows."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.sums = dict.fromkeys(SUMS, 0)
        self.low = self.high = None
        self.last = None
        self.best = {START: (0, Node("", None))}
        self.audit = None

    def piece(self, r: dict) -> None:
        for c in SUMS:
            self.sums[c] += r[c]
        if self.last is not None:
            self.sums["illegal"] += int(self.last + r["first"] not in LEGAL)
            self.sums["turns"] -= int(r["first_turn"] is not None and r["first_turn"] == self.high)
        self.last = r["last"]
        # turns come in order, nulls first
        if r["last_turn"] is not None:
            self.high = r["last_turn"]
        if r["low"] is not None and self.low is None:
            self.low = r["low"]
        self.best = step(self.best, [(w["s"], w["t"], w["letters"], w["cost"]) for w in r["ways"]])

    def decide(self) -> None:
        self.cost, node = finish(self.best)
        self.audit = "".join(letters_to(node))[:-1]
        self.at, self.speaker = 0, Speaker()

    def row(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.decide()
        end = self.at
        while self.audit[end] == "I":
            end += 1
        self.speaker.row(self.audit[self.at : end + 1], role, text)
        self.at = end + copies

    def result(self) -> tuple:
        for _ in self.audit[self.at :]:
            self.speaker.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["turns"]
        return (self.conv_id, gaps, *(self.sums[c] for c in _RESULT[1:5]), self.cost, self.audit, self.speaker.sha.hexdigest())


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of every conversation; its pieces (place 0) come first, then its rows, in order."""
    own, out = None, []
    names = ["conv_id", *_RESULT, "audit", "repaired_sha256"]

    def flush() -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if own is None or own.conv_id != r["conv_id"]:
                if own is not None:
                    out.append(own.result())
                own = _Conversation(r["conv_id"])
            if r["place"] == 0:
                own.piece(r)
            else:
                own.row(r["role"], r["text"], r["copies"])
        if out:
            yield flush()
            out = []
    if own is not None:
        out.append(own.result())
        yield flush()


def repair(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text): what is wrong, and its cheapest repair.

    Rows are taken by turn (null first; of one turn by role and text).  A row is
    blank (no character but space and U+0009 to U+000D), or a duplicate (role and
    text seen earlier in the conversation), or truncated (its last such character
    is not ``.``, ``!`` or ``?``); blank, duplicate and truncated count rows by
    their first fault, illegal the neighbours whose roles' initials are not su,
    ua or au, gaps the turn numbers that lack.  A repair keeps (K, 0), gives
    another role (R, 3), deletes (D, 4; a must for blank and duplicate rows) and
    inserts empty turns (I, 3), a truncated row that stays costs 3 more, and what
    remains has role initials ``(s?(ua)+)?``.  cost is the least, audit its
    edits' letters in order, ASCII-least among repairs of that cost;
    repaired_sha256 is the hash of the repaired ``role:text``, newline-joined.

    A null role or text counts as one space; a null conv_id is a conversation of
    its own.  Repeated rows are duplicates of each other.  Other columns are not
    read; no rows give no rows.
    """
    part = ["conv_id", "role", "text"]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("salt", salt("turn"))
    # a text that a conversation repeats in very many turns meets its first turn in several tasks
    first = rows.withColumn("salt", salt("turn")).groupBy(*part).agg(
        F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("no_turn"), salts()
    )
    first = each_salt(first).select(*[F.col(c).alias(f"_{c}") for c in [*part, "salt"]], "first_turn", "no_turn")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*part, "salt"]]
    seen = F.col("turn").isNotNull() & (F.col("no_turn") | (F.col("turn") > F.col("first_turn")))
    marked = distinct.join(first, same).select("conv_id", "turn", "role", "text", "copies", seen.alias("seen"))
    order = ["conv_id", "turn", "role", "text"]
    pieces = marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces(piece_rows), ", ".join(f"{c} {t}" for c, t in _PIECE.items()))
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place") > 0, "part", "place").mapInArrow(_joined, _OUT)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """:func:`repair` of the damaged rows, with every conv_id: one that lost all its rows has zeros, no edits and the hash of nothing."""
    done = repair(damage(conversations)).withColumnRenamed("conv_id", "_conv_id")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _RESULT}
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")]
    return ids.join(done, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select("conv_id", *zeros.values(), *texts)
