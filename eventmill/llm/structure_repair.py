"""Repair of conversations: the cheapest edits that make roles alternate, by a checkpointed dynamic program.

The roles of a repaired conversation read, by their first letters, ``(s?(ua)+)?``. Four states accept that:
nothing yet, after the system turn, after a user turn, after an assistant turn. Going backward over the rows, a
vector holds for each state the least cost of the rest. Only the vectors at every square-root-th row are kept;
walking forward, the block at hand is computed again from the next checkpoint, and of the edits that stay on
the least cost the one with the least letter is taken: D(elete), I(nsert), K(eep), R(erole). State and letter
determine the next state, so that is the ASCII-least of all cheapest edits, and memory is a few vectors times
the root of the length besides a byte a row.

The program needs no texts: a first pass shuffles a role's letter, a fault and a digest of each row, and gives
the edits. A second pass brings them to the rows and hashes the repaired conversation as it streams by, so a
task never holds a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import BLANKS
from .turns import checksum, turn_digest
from .workspace import ship

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: b"user", ASSISTANT: b"assistant"}
#: After each state, the one that an inserted or reroled turn leads to.
_NEXT = (USER, USER, ASSISTANT, USER)
#: The state that a kept turn leads to, by state and letter; else it can't be kept.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_LETTERS = "sua"
_NEVER = 1 << 60
#: What costs nothing more at the end: an empty conversation, or one that ends on an assistant turn.
_END = (0, 2 * INSERT, INSERT, 0)

# A row's code: 0 must go; else 1 + the place of its letter (3: another), plus 4 if it is cut off.
MUST_GO = 0


def code_of(letter: str, truncated: bool) -> int:
    return 1 + (_LETTERS.find(letter) if letter in ("s", "u", "a") else 3) + 4 * truncated


def _keeps(code: int) -> tuple[int | None, ...]:
    """From each state, the one that keeping the row leads to."""
    letter = (_LETTERS + "x")[(code - 1) % 4] if code else "x"
    return tuple(_KEPT.get((state, letter)) for state in range(4))


_KEEPS = tuple(_keeps(code) for code in range(9))


def _before(code: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """The costs from a row on, by state, given those after it."""
    cost = [DELETE + c for c in rest]
    if code:
        more = CUT_OFF if code > 4 else 0
        for state, kept in enumerate(_KEEPS[code]):
            cost[state] = min(cost[state], REROLE + more + rest[_NEXT[state]])
            if kept is not None:
                cost[state] = min(cost[state], more + rest[kept])
    for _ in range(3):  # inserts before the row; from any state no more than three lead on
        cost = [min(c, INSERT + cost[_NEXT[state]]) for state, c in enumerate(cost)]
    return tuple(cost)


def _vectors(codes: bytes, begin: int, end: int, rest: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The costs at each row from ``begin`` to ``end``, the latter's being ``rest``."""
    out = [rest]
    for at in range(end - 1, begin - 1, -1):
        out.append(_before(codes[at], out[-1]))
    return out[::-1]


def edits(codes: bytes) -> tuple[int, str]:
    """The least cost, and the letters of the edits: the ASCII-least among the cheapest."""
    n = len(codes)
    block = isqrt(n) + 1
    kept = {n: _END}
    cost = _END
    for at in range(n - 1, -1, -1):
        cost = _before(codes[at], cost)
        if at % block == 0:
            kept[at] = cost
    out, state = [], START
    for begin in range(0, n + 1, block):
        end = min(begin + block, n)
        vectors = _vectors(codes, begin, end, kept[end])
        last = end == n
        at = begin
        while at < end or last:
            now = vectors[at - begin][state]
            if at < n and now == DELETE + vectors[at + 1 - begin][state]:
                out.append("D")
                at += 1
                continue
            if at == n and now == (0 if state in (START, ASSISTANT) else _NEVER):
                break
            if now == INSERT + vectors[at - begin][_NEXT[state]]:
                out.append("I")
                state = _NEXT[state]
                continue
            after, more = vectors[at + 1 - begin], CUT_OFF if codes[at] > 4 else 0
            keep = _KEEPS[codes[at]][state]
            if keep is not None and now == more + after[keep]:
                out.append("K")
                state = keep
            else:
                out.append("R")
                state = _NEXT[state]
            at += 1
        if last:
            break
    return kept[0][START], "".join(out)


_short = lru_cache(1 << 14)(edits)


def _edits(codes: bytes) -> tuple[int, str]:
    return _short(codes) if len(codes) <= 64 else edits(codes)


# Damage


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone), a fifth of them damaged as the checksum of id and turn says.

    0 drops a row (it stays as ``gone``), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes
    it the user's. What is null counts as one space, in the checksum too.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), (checksum(key) % 20).alias("fault"))
    no_ends = F.translate("text", ".!?", "")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, no_ends).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"),
                       F.when(F.col("fault") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode(F.sequence(F.lit(1), "times")).alias("copy")).drop("copy")


# The passes


class _Conversation:
    """What the first pass remembers of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.seen: set[bytes] = set()
        self.turns: list[int] = []  # the least, the last, how many
        self.before: str | None = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, letter: str, blank: bool, truncated: bool, digest: bytes) -> None:
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        if self.before is not None and self.before + letter not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = letter
        again = digest in self.seen
        self.seen.add(digest)
        if blank:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif truncated:
            self.truncated += 1
        self.codes.append(MUST_GO if blank or again else code_of(letter, truncated))

    def row(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        cost, audit = _edits(bytes(self.codes))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_SCHEMA = pa.schema([*((c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])
_HASHED = pa.schema([*_SCHEMA, ("repaired_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, turn and digest, to a row for each conversation."""
    at: _Conversation | None = None
    for rows in batches:
        out = []
        for conv, turn, gone, letter, blank, truncated, digest in zip(*(c.to_pylist() for c in rows.columns)):
            if at is None or conv != at.conv_id:
                if at:
                    out.append(at.row())
                at = _Conversation(conv)
            if not gone:
                at.add(turn, letter, blank, truncated, digest)
        if out:
            yield _batch(out, _SCHEMA)
    if at:
        yield _batch([at.row()], _SCHEMA)


class _Repair:
    """Applies edits to a conversation's rows as they come, and hashes the result."""

    def __init__(self, found: tuple):
        self.found, self.audit = found, found[-1]
        self.at, self.state, self.sha, self.begun = 0, START, hashlib.sha256(), False

    def _put(self, role: bytes, text: bytes) -> None:
        self.sha.update((b"\n" if self.begun else b"") + role + b":")
        self.sha.update(text)
        self.begun = True

    def _step(self) -> bytes:
        self.state = _NEXT[self.state]
        return ROLES[self.state]

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(self._step(), b"")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._put(self._step(), text.encode())
        elif edit == "K":
            self.state = _KEPT[self.state, role[:1]]
            self._put(role.encode(), text.encode())

    def result(self) -> tuple:
        self.inserts()
        return *self.found, self.sha.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation first its edits, then its rows in order; to a row with the hash of what it becomes."""
    at: _Repair | None = None
    names = _SCHEMA.names
    for rows in batches:
        out = []
        for found, role, text in zip(zip(*(rows.column(c).to_pylist() for c in names)), rows.column("role").to_pylist(), rows.column("text").to_pylist()):
            if found[-1] is not None:
                if at:
                    out.append(at.result())
                at = _Repair(found)
            else:
                at.row(role, text)
        if out:
            yield _batch(out, _HASHED)
    if at:
        yield _batch([at.result()], _HASHED)


def audits(turns: DataFrame) -> DataFrame:
    """Of each conversation its faults and edits, from rows as ``damaged`` gives them: see ``repair``."""
    ship(turns.sparkSession)
    blanks = F.lit(BLANKS)
    ending = F.right(F.rtrim("text", blanks), F.lit(1))
    rows = turns.select(
        "conv_id", "turn", "gone", F.substring("role", 1, 1).alias("letter"), (ending == "").alias("blank"),
        (~ending.isin(".", "!", "?")).alias("truncated"), turn_digest(F.col("role"), F.col("text")).alias("digest"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest").mapInArrow(_audits, RESULT)


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns``: (conv_id, turn, role, text, gone), with neither role nor text null; a ``gone`` row only makes its
    conversation known. gaps: absent turn numbers between the least and the largest. blank, duplicate,
    truncated: rows by their first fault. illegal: neighbours whose roles' letters are not su, ua or au. cost and
    audit: the cheapest edits, a letter each. The hash is of the repaired rows as ``role:text``, a line each.

    Decided cases: rows go by turn, null first, and among equal turns by a digest of role and text, so equal
    rows are neighbours. An empty role has no letter and is never kept. Rows without conv_id are one
    conversation, of id null. A conversation without rows has zeros, no edits and the empty text's hash. No
    rows give no conversations. Other columns are ignored. A task holds, of one conversation, its edits, and
    some hundred bytes for each of its different rows, to tell repeats; texts stream by.
    """
    found = audits(turns)
    none = {c: F.lit(None) for c in ("turn", "digest", "role", "text")}
    first = found.withColumns({c: v.cast(t) for (c, v), t in zip(none.items(), ("long", "binary", "string", "string"))})
    rows = turns.where("not gone").select(
        "conv_id", *(F.lit(None).cast("long").alias(c) for c in _SCHEMA.names[1:-1]), F.lit(None).cast("string").alias("audit"),
        "turn", turn_digest(F.col("role"), F.col("text")).alias("digest"), "role", "text")
    both = first.unionByName(rows)
    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "digest")
    return sorted_.select(*_SCHEMA.names, "role", "text").mapInArrow(_hashed, RESULT + ", repaired_sha256 string")
