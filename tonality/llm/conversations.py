"""Structure repair of conversations by secondary-sorted streaming.

The rows are partitioned by conversation and sorted by turn; ``mapInPandas``
then reads each partition as one stream and carries the state of a dynamic
program across the Arrow batches, so a conversation never has to be in memory
as a whole.

* Faults. A row's first fault counts: *blank* (no character outside
  ``[\\x20\\x09-\\x0D]``), *duplicate* (its role and text were seen earlier in the
  conversation), *truncated* (the last such character is not one of ``.!?``).
* Edits. Keep (cost 0), Rerole to user or assistant (2), Delete (3; the only
  edit of blank and duplicate rows), Insert an empty user or assistant turn
  anywhere (2). A truncated row that stays costs 1 more. The initials of the
  roles must become ``(s?(ua)+)?``; among the cheapest edits the sequence of
  initials that is least in ASCII order is taken.
* Dynamic program. Four states say what came last (nothing, system, user,
  assistant); each keeps its cheapest cost and the rank of its edit sequence
  among the four. That is enough to break ties: two sequences up to the same
  row never are a beginning of one another, as both end with the edit of that
  row. Costs are kept relative to the least, and a state that is more than
  ``SLACK`` dearer can't win any more; so there are few different situations,
  and a step is a table look-up.
* Backpointers. Each row leaves four bytes. Beyond ``SPILL_BYTES`` they go to
  an anonymous temporary file of the task, and are read back from its end.
* Each state also carries the SHA-256 of the repaired text so far, so texts are
  read once.
* Duplicates in earlier turns are found by Spark on fingerprints (no set of
  seen texts in a task): markers travel in the same sort, just before the row
  that they mark.

Defined results: a null role or text counts as one space; a null turn sorts
first; rows of one turn are ordered by role and fingerprint of the text; the
null conversation is one like any other; roles with another initial than
``s u a`` (or none) must be reroled or deleted; repeated rows are duplicates;
a conversation without rows gets zeros, no edits and the hash of the empty
string; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, bounded_batches

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what a state emitted last
DELETE, KEEP, REROLE = range(3)
INITIALS = "DKR"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
SLACK = 8
NO_MOVE = 255
SPILL_BYTES = 4 << 20
#: Row types: 8 * first letter (s, u, a, other) + 2 * must go + truncated.
LETTERS = "sua"

Vector = tuple[tuple[int, int] | None, ...]  # per state: (relative cost, rank)


def _options(state: int, row_type: int) -> Iterator[tuple[int, int, str, int]]:
    """(next state, cost, initials added, move) of the edits of a row; a move is
    state + 4 * inserted before + 8 * edit."""
    letter, gone, truncated = row_type >> 3, row_type >> 1 & 1, row_type & 1
    yield state, DELETE_COST, "D", state + 8 * DELETE
    if gone:
        return
    if letter == 0 and state == NOTHING:
        yield SYSTEM, truncated * TRUNCATED_COST, "K", state + 8 * KEEP
    for to in (USER, ASSISTANT):
        fits = (state == USER) == (to == ASSISTANT)  # an assistant follows a user, a user anything else
        cost = truncated * TRUNCATED_COST + (0 if fits else INSERT_COST)
        before = "" if fits else "I"
        if letter == to - 1:  # letters u, a are 1, 2
            yield to, cost, before + "K", state + 4 * (not fits) + 8 * KEEP
        yield to, cost + REROLE_COST, before + "R", state + 4 * (not fits) + 8 * REROLE


FIRST: Vector = ((0, 0), None, None, None)


def step(vector: Vector, row_type: int) -> tuple[Vector, int, bytes]:
    """The states after one more row: (vector, least cost added, moves)."""
    best: dict[int, tuple[int, int, str, int]] = {}
    for state, at in enumerate(vector):
        if at is None:
            continue
        for to, cost, added, move in _options(state, row_type):
            found = (at[0] + cost, at[1], added, move)
            if to not in best or found[:3] < best[to][:3]:
                best[to] = found
    least = min(x[0] for x in best.values())
    best = {to: x for to, x in best.items() if x[0] <= least + SLACK}
    rank = {to: i for i, to in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
    after = tuple((best[s][0] - least, rank[s]) if s in best else None for s in range(4))
    return after, least, bytes(best[s][3] if s in best else NO_MOVE for s in range(4))


def end(vector: Vector) -> tuple[int, int, str]:
    """(cost added, last state, insertions) of the cheapest way to finish."""
    closing = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    found = [(at[0] + INSERT_COST * len(closing[s]), at[1], s) for s, at in enumerate(vector) if at is not None]
    cost, _, state = min(found)
    return cost, state, closing[state]


class Backpointers:
    """Four bytes a row, in memory up to ``limit`` bytes, then in a temporary
    file that goes with the task."""

    def __init__(self, limit: int):
        self.limit, self.tail, self.file, self.rows = limit, bytearray(), None, 0

    def add(self, moves: bytes) -> None:
        self.tail += moves
        self.rows += 1
        if len(self.tail) >= self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.tail.clear()

    def backwards(self) -> Iterator[bytes]:
        """Blocks of moves, the last first."""
        yield bytes(self.tail)
        if self.file is not None:
            at = self.file.tell()
            while at:
                size = min(at, self.limit - self.limit % 4)
                at -= size
                self.file.seek(at)
                yield self.file.read(size)

    def audit(self, state: int, closing: str) -> str:
        out = bytearray(closing.encode())
        initials = [bytes([ord(c)]) for c in INITIALS]
        for block in self.backwards():
            for row in range(len(block) // 4 - 1, -1, -1):
                move = block[4 * row + state]
                out += initials[move >> 3] + (b"I" if move & 4 else b"")
                state = move & 3
        out.reverse()
        return out.decode()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Conversation:
    """The carried state of one conversation."""

    def __init__(self, key: int | None, spill: int):
        self.key, self.vector, self.cost = key, FIRST, 0
        self.back = Backpointers(spill)
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.letter: int | None = None
        self.least = self.most = self.turn = None
        self.turns = 0
        self.marked = self.row = None

    def add(self, turn: int | None, role: str, text: str, print_: bytes, row_type: int, blank: bool, known: dict) -> None:
        letter = row_type >> 3
        if self.letter is not None and (self.letter, letter) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.letter = letter
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        row = (turn, role, print_)
        if blank:
            self.blank += 1
        elif row in (self.marked, self.row):
            self.duplicate += 1
            row_type |= 2
        else:
            self.truncated += row_type & 1
        self.row = row
        found = known.get((self.vector, row_type))
        if found is None:
            found = known[self.vector, row_type] = step(self.vector, row_type)
        self.vector, more, moves = found
        self.cost += more
        self.back.add(moves)
        line, hashes = None, self.hashes
        self.hashes = [None] * 4
        for state, move in enumerate(moves):
            if move == NO_MOVE:
                continue
            before = hashes[move & 3]
            if move >> 3 != DELETE:
                if line is None:
                    line = text.encode()
                before = before.copy()
                if move & 3 != NOTHING:
                    before.update(b"\n")
                if move & 4:
                    before.update(b"assistant:\n" if state == USER else b"user:\n")
                name = role.encode() if move >> 3 == KEEP else b"user" if state == USER else b"assistant"
                before.update(name + b":" + line)
            self.hashes[state] = before

    def finish(self) -> tuple:
        more, state, closing = end(self.vector)
        audit = self.back.audit(state, closing)
        self.back.close()
        repaired = self.hashes[state]
        if closing:
            repaired.update(b"\nuser:\nassistant:" if len(closing) == 2 else b"\nassistant:")
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + more, audit,
            repaired.hexdigest(), self.back.rows,
        )


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_rows long"
)
MARKER, ROW, ANNOUNCE = range(3)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c, kind in (x.split() for x in schema.split(", ")) if kind == "long"})


def _repair_stream(spill: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        now: Conversation | None = None
        for batch in batches:
            done = []
            columns = ["conv_null", "conv", "turn_null", "turn", "role", "print", "kind", "text", "row_type", "blank"]
            for conv_null, conv, turn_null, turn, role, print_, kind, text, row_type, blank in zip(
                *(batch[c].tolist() for c in columns), strict=True
            ):
                key = None if conv_null else conv
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.finish())
                    now = Conversation(key, spill)
                if kind == ROW:
                    now.add(None if turn_null else turn, role, text, print_, row_type, blank, known)
                elif kind == MARKER:
                    now.marked = (None if turn_null else turn, role, print_)
            if done:
                yield _frame(done, RESULT)
        if now is not None:
            yield _frame([now.finish()], RESULT)

    return run


KEYS = ["conv_null", "conv", "turn_null", "turn", "role", "print"]


def _rows(conversations: DataFrame) -> DataFrame:
    """The rows with plain keys (null flags beside the numbers, so that pandas
    keeps them whole) and a fingerprint of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    number = lambda c: (F.col(c).isNull().alias(f"{c[:4]}_null"), F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c[:4]))
    announced = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in conversations.columns else F.lit(False)
    return conversations.select(
        *number("conv_id"),
        *number("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.unhex(F.md5(text)).alias("print"),
        F.when(announced, ANNOUNCE).otherwise(ROW).alias("kind"),
        F.when(announced, F.lit("")).otherwise(text).alias("text"),
    )


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    """One conversation in one partition, its rows in order."""
    order = ["conv_null", "conv", *first, F.col("turn_null").desc(), "turn", "role", "print", "kind"]
    return rows.repartition("conv_null", "conv").sortWithinPartitions(*order)


def _markers(rows: DataFrame) -> DataFrame:
    """One row (kind MARKER) or more for each turn, role and text that an
    earlier turn of the conversation has too. Works on fingerprints: the texts
    don't travel; a hot text only costs partial aggregates."""
    group = ["conv_null", "conv", "role", "print"]
    place = F.struct((~F.col("turn_null")).alias("known"), F.col("turn"))
    slim = rows.where(F.col("kind") == ROW).select(*KEYS)
    first = slim.groupBy(*group).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    later = slim.join(first.select(*group, "first"), group).where(place > F.col("first")).select(*KEYS)
    return later.withColumn("kind", F.lit(MARKER)).withColumn("text", F.lit(""))


def repair(conversations: DataFrame, spill: int = SPILL_BYTES) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256, n_rows``. Rows whose column ``dropped`` is
    true only say that their conversation exists."""
    bounded_batches(conversations.sparkSession)
    rows = _rows(conversations)
    typed = rows.unionByName(_markers(rows))
    core = F.rtrim("text", F.lit(WHITE))
    letter = F.coalesce(*[F.when(F.col("role").startswith(c), i) for i, c in enumerate(LETTERS)], F.lit(len(LETTERS)))
    blank = core == ""
    truncated = ~blank & ~F.substring(core, -1, 1).isin(".", "!", "?")
    typed = typed.select(
        *KEYS, "kind", "text", (letter * 8 + blank.cast("int") * 2 + truncated.cast("int")).cast("int").alias("row_type"), blank.alias("blank")
    )
    return _sorted(typed).mapInPandas(_repair_stream(spill), RESULT)


REPAIRED = "conv_id long, position long, role string, text string, edit string"


def _apply_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, audit, at, position, paired = object(), "", 0, 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, position, paired
        while audit[at : at + 1] == "I":
            yield key, position, ("user", "assistant")[paired % 2], "", "I"
            at, position, paired = at + 1, position + 1, paired + 1

    for batch in batches:
        done: list[tuple] = []
        columns = ["conv_null", "conv", "kind", "role", "text", "audit"]
        for conv_null, conv, kind, role, text, edits in zip(*(batch[c].tolist() for c in columns), strict=True):
            if kind == MARKER:  # the head of a conversation
                done += inserted()
                key, audit, at, position, paired = None if conv_null else conv, edits, 0, 0, 0
            elif kind == ROW:
                done += inserted()
                edit = audit[at]
                at += 1
                if edit != "D":
                    first = edit == "K" and role[:1] == "s"
                    name = role if edit == "K" else ("user", "assistant")[paired % 2]
                    done.append((key, position, name, text, edit))
                    position, paired = position + 1, paired + (not first)
        if done:
            yield _frame(done, REPAIRED)
    if rest := list(inserted()):
        yield _frame(rest, REPAIRED)


def repaired_rows(conversations: DataFrame, repairs: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, edit``: the rows that remain, in order,
    after the edits of ``repair`` (its ``audit`` tells all of them)."""
    head = repairs.select(
        F.col("conv_id").isNull().alias("conv_null"),
        F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"),
        F.lit(True).alias("turn_null"),
        F.lit(0).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit(b"").alias("print"),
        F.lit(MARKER).alias("kind"),
        F.lit("").alias("text"),
        "audit",
    )
    rows = _rows(conversations).withColumn("audit", F.lit(""))
    both = head.unionByName(rows).withColumn("later", F.col("kind") != MARKER)
    return _sorted(both, "later").mapInPandas(_apply_stream, REPAIRED)


def damage(conversations: DataFrame) -> DataFrame:
    """Known faults for trials, by h = crc32(``conv_id:turn``) % 20: 0 drops the
    row (it stays with ``dropped``), 1 empties the text, 2 removes its ``.!?``,
    3 repeats the row, 4 sets the role to user. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), h.alias("h"))
    text: Column = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("h") == 0).alias("dropped"),
        F.explode(times).alias("time"),
    ).drop("time")
