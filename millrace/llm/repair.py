"""Conversation structure repair by iterative-deepening A*.

The turns of a conversation are edited until their roles read ``(s?(ua)+)?``:
an optional system turn, then user and assistant in turn.  A depth-first search
tries the edits of each turn in ASCII order (Delete, Insert, Keep, Rerole)
under a cost bound.  A table keeps for each (turn, role state) the least cost
that is still possible from there; a state that fails raises its entry to the
least its children leave open, which prunes it until the bound reaches that,
and the entry of the start is the next bound.  So the bound never passes the
cheapest cost, and the first path that is accepted is the ASCII-least of the
cheapest ones.

Rows are dealt by range of (conversation, turn), so that one conversation may
span many tasks.  A conversation that lies within a task is searched there; one
that is cut is searched block by block, from each role state to each, and the
blocks' paths are put together afterwards.  Inserts belong to the edit after
them, so no path of a block begins another and the least paths of blocks make
the least path of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import product

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import stored

#: Rows and bytes of text of a block at most (a longer text is a block of its own).
BLOCK, BLOCK_BYTES = 1024, 8 << 20
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Role states: nothing yet, after the system turn, a user's turn done, a pair done.
START, SYSTEM, USER, PAIR = range(4)
_AFTER_INSERT = (USER, USER, PAIR, USER)
_WHOLE = (START, PAIR)
#: A turn that must go; other classes are a role's place in "sua" (3: none of them), doubled, plus 1 if it is truncated.
GONE = 8
_NEVER = 1 << 60

_BLANKS = " \t\n\x0b\x0c\r"


def _moves(kind: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of a turn of this class in this role state: letter, cost, turns consumed, next state."""
    moves = [("D", DELETE, 1, state), ("I", INSERT, 0, _AFTER_INSERT[state])]
    if kind == GONE:
        return moves
    role, extra = kind // 2, TRUNCATED * (kind % 2)
    fits = {0: state == START, 1: state != USER, 2: state == USER, 3: False}[role]
    if fits:
        moves.append(("K", extra, 1, SYSTEM if role == 0 else _AFTER_INSERT[state]))
    if not fits or role == 0:
        moves.append(("R", REROLE + extra, 1, _AFTER_INSERT[state]))
    return moves


_MOVES = [[_moves(kind, state) for state in range(4)] for kind in range(GONE + 1)]
_TAIL = [[("I", INSERT, 0, _AFTER_INSERT[state])] for state in range(4)]
_NO_MOVES: list[list] = [[]] * 4
_FLOOR = [min(DELETE, TRUNCATED * (kind % 2)) if kind != GONE else DELETE for kind in range(GONE + 1)]


@lru_cache(maxsize=1 << 16)
def cheapest(kinds: bytes, start: int = START, goals: tuple[int, ...] = _WHOLE, tail: bool = True) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits of turns of these classes from one role state to one of ``goals``.

    Of several the ASCII-least.  None if no edits lead there.  Without ``tail``
    nothing is inserted after the last turn.
    """
    n = len(kinds)
    if not tail and not any(_reachable(kinds, start, goal) for goal in goals):
        return None
    least = [[0] * 4 for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        least[i] = [least[i + 1][0] + _FLOOR[kinds[i]]] * 4
    if not tail:
        least[n] = [0 if state in goals else _NEVER for state in range(4)]
    at_end = _TAIL if tail else _NO_MOVES
    while True:
        path: list[str] = []
        bound = least[0][start]
        # A frame: turn, state, budget left, moves not tried yet, least cost its failed moves leave, cost of the move into it.
        frames = [[0, start, bound, iter(_MOVES[kinds[0]][start] if n else at_end[start]), _NEVER, 0]]
        while frames:
            frame = frames[-1]
            i, state, budget = frame[0], frame[1], frame[2]
            if i == n and state in goals:
                return bound, "".join(path)
            for letter, cost, step, then in frame[3]:
                i2 = i + step
                open_ = least[i2][then]
                if cost + open_ <= budget:
                    moves = _MOVES[kinds[i2]][then] if i2 < n else at_end[then]
                    frames.append([i2, then, budget - cost, iter(moves), _NEVER, cost])
                    path.append(letter)
                    break
                frame[4] = min(frame[4], cost + open_)
            else:
                least[i][state] = max(least[i][state], frame[4])
                frames.pop()
                if frames:
                    path.pop()
                    frames[-1][4] = min(frames[-1][4], frame[5] + least[i][state])


def _reachable(kinds: bytes, start: int, goal: int) -> bool:
    """Whether any edits lead from one state to another without inserts after the last turn."""
    if goal == start:
        return True
    if goal == SYSTEM:
        return start == START and any(kind in (0, 1) for kind in kinds)
    return goal != START and len(kinds) > 0


def repaired(letters: str, state: int, roles: list[str], texts: list[str]) -> tuple[str, bool]:
    """``role:text`` lines that the edits make of a block entered in a role state, and whether there are any."""
    lines, row = [], 0
    for letter in letters:
        if letter == "K":
            lines.append(f"{roles[row]}:{texts[row]}")
            state = SYSTEM if roles[row][:1] == "s" else _AFTER_INSERT[state]
        elif letter in "IR":
            said = "" if letter == "I" else texts[row]
            lines.append(f"{'assistant' if state == USER else 'user'}:{said}")
            state = _AFTER_INSERT[state]
        row += letter != "I"
    return "\n".join(lines), bool(lines)


def damage(turns: DataFrame) -> DataFrame:
    """The turns after damage by crc32(``conv_id:turn``) % 20, one row per different row, with ``copies`` and ``dropped``.

    Nulls in the key, the role and the text count as one space.  0 drops a row,
    1 empties its text, 2 takes its ``[.!?]`` away, 3 repeats it, 4 makes it a
    user's.  Dropped rows stay, marked, so that no conversation is lost.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("harm"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("harm") == 0).alias("dropped"), F.when(F.col("harm") == 3, 2).otherwise(1).alias("copies"))
    return rows.groupBy("conv_id", "turn", "role", "text", "dropped").agg(F.sum("copies").alias("copies"))


def numbered(rows: DataFrame) -> DataFrame:
    """Each row as often as it stands there, with ``again``: whether its role and text came earlier.

    A conversation's rows go by turn (null first), role, text.
    """
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    said = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    rows = rows.withColumns({"at": turn, "said": said})
    first = rows.where(~F.col("dropped")).groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min("at").alias("first"))
    met = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left_outer")
    nth = met.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    again = ~(F.col("first").eqNullSafe(F.col("at")) & (F.col("nth") == 1))
    return nth.select("conv_id", "turn", "role", "text", "nth", "dropped", again.alias("again"))


def _states(costs_from: Iterator[tuple[int, int, tuple[int, str] | None]]) -> list[dict]:
    return [{"start": a, "goal": b, "cost": found[0], "letters": found[1]} for a, b, found in costs_from if found]


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ("paths", pa.list_(pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])
_SEGMENT_SQL = (
    "conv_id long, segment long, whole boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, cost long, audit string, repaired_sha256 string, "
    "paths array<struct<start:int,goal:int,cost:long,letters:string>>, roles array<string>, texts array<string>")
_LEGAL = {"su", "ua", "au"}


class _Block:
    """Rows of one conversation in order, as many as are searched at once."""

    def __init__(self, conv: int | None):
        self.conv, self.bytes, self.rows = conv, 0, 0
        self.kinds, self.roles, self.texts = bytearray(), [], []
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = 0

    def add(self, turn: int | None, role: str, text: str, dropped: bool, again: bool) -> None:
        self.rows += 1
        if dropped:
            return
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        kind, kept = GONE, text.rstrip(_BLANKS)
        if not kept:
            self.blank += 1
        elif again:
            self.duplicate += 1
        else:
            cut = kept[-1] not in ".!?"
            self.truncated += cut
            at = "sua".find(role[:1]) if role else -1
            kind = 2 * (at if at >= 0 else 3) + cut
        self.kinds.append(kind)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def record(self, segment: int, whole: bool) -> dict:
        kinds, initials = bytes(self.kinds), [role[:1] for role in self.roles]
        row = {
            "conv_id": self.conv, "segment": segment, "whole": whole, "low": self.low, "high": self.high, "turns": self.turns,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        }
        if whole:
            cost, letters = cheapest(kinds)
            text, _ = repaired(letters, START, self.roles, self.texts)
            return row | {"cost": cost, "audit": letters, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
        paths = _states((a, b, cheapest(kinds, a, (b,), False)) for a, b in product(range(4), range(4)))
        return row | {"paths": paths, "roles": self.roles, "texts": self.texts}


def _searched(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows that come in order; the first and the last conversation of a task may go on in others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, block, edge, made = TaskContext.get().partitionId() << 32, None, True, 0
        for batch in batches:
            out: list[dict] = []
            for conv, turn, role, text, dropped, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None:
                    block = _Block(conv)
                elif conv != block.conv:
                    out.append(block.record(base + made, not edge))
                    block, edge, made = _Block(conv), False, made + 1
                elif block.rows >= most or block.bytes + len(text) > BLOCK_BYTES:
                    out.append(block.record(base + made, False))
                    block, edge, made = _Block(conv), True, made + 1
                block.add(turn, role, text, dropped, again)
            if out:
                yield pa.RecordBatch.from_pylist(out, _SEGMENT)
        if block is not None:
            yield pa.RecordBatch.from_pylist([block.record(base + made, False)], _SEGMENT)

    return run


_CHOSEN = "conv_id long, segment long, state int, letters string, cost long, gaps long, illegal long"


def _put_together(blocks: pd.DataFrame) -> pd.DataFrame:
    """The cheapest way through the blocks of one conversation; only paths come here, no texts."""
    blocks = blocks.sort_values("segment")
    best = {START: (0, "", ())}
    gaps_turns, low, high, illegal, last = 0, None, None, 0, None
    for row in blocks.itertuples():
        ways: dict[int, list] = {}
        for path in row.paths:
            if path["start"] in best:
                cost, letters, marks = best[path["start"]]
                ways.setdefault(path["goal"], []).append((cost + path["cost"], letters + path["letters"], (*marks, (path["start"], len(path["letters"])))))
        best = {goal: min(found) for goal, found in ways.items()}
        illegal += int(row.illegal)
        if isinstance(row.first, str):
            illegal += last is not None and last + row.first not in _LEGAL
            last = row.last
        if not pd.isna(row.low):
            gaps_turns += int(row.turns) - (high is not None and high == row.low)
            low, high = row.low if low is None else low, row.high
    tails = {state: cheapest(b"", state) for state in best}
    cost, letters, marks = min((cost + tails[s][0], letters + tails[s][1], marks) for s, (cost, letters, marks) in best.items())
    gaps = 0 if low is None else int(high) - int(low) + 1 - gaps_turns
    at, rows = 0, []
    for k, (segment, (state, length)) in enumerate(zip(blocks["segment"], marks, strict=True)):
        end = len(letters) if k == len(marks) - 1 else at + length
        rows.append((blocks["conv_id"].iloc[0], segment, state, letters[at:end], cost, gaps, illegal))
        at = end
    return pd.DataFrame(rows, columns=["conv_id", "segment", "state", "letters", "cost", "gaps", "illegal"])


@F.pandas_udf(T.StringType())
def _repaired_block(letters: pd.Series, state: pd.Series, roles: pd.Series, texts: pd.Series) -> pd.Series:
    made = [repaired(*row) for row in zip(letters, state, roles, texts, strict=True)]
    return pd.Series([text if any_ else None for text, any_ in made], dtype=object)


def _gaps() -> Column:
    return F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each conversation's faults, its cheapest repair and the hash of the repaired text.

    ``rows``: conv_id, turn, role, text, dropped, copies (as ``damage`` gives
    them; other columns are ignored), no nulls in role and text.  Repeated rows
    are repeated turns, so all but the first are duplicates; a null conv_id is a
    conversation; rows without a turn come first.  A conversation without rows
    that are not dropped has zeros and the hash of the empty text.  An empty
    table gives no rows.  Texts of any length stay whole.  ``block`` is the
    number of rows searched at once and changes no result.
    """
    names = ("conv_id", "turn", "role", "text", "dropped", "again")
    laid = stored(numbered(rows.select("conv_id", "turn", "role", "text", "dropped", "copies")), "turns")
    order = ("conv_id", "turn", "role", "text", "dropped", "nth")
    dealt = laid.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)
    blocks = stored(dealt.mapInArrow(_searched(block), _SEGMENT_SQL), "conversations")
    counts = ("blank", "duplicate", "truncated")
    whole = blocks.where("whole").select("conv_id", _gaps().alias("gaps"), *counts, "illegal", "cost", "audit", "repaired_sha256")
    # Every column but the texts; one block is no more than BLOCK rows.
    cut = blocks.where("not whole")
    chosen = cut.select("conv_id", "segment", "low", "high", "turns", "illegal", "first", "last", "paths").groupBy("conv_id").applyInPandas(_put_together, _CHOSEN)
    # A segment's number is its own in the whole table.
    pieces = cut.select("segment", *counts, "roles", "texts").join(chosen, "segment").select(
        "conv_id", "segment", "letters", "cost", "gaps", "illegal", *counts, _repaired_block("letters", "state", "roles", "texts").alias("piece"))
    told = lambda field: F.transform(F.array_sort(F.collect_list(F.struct("segment", field))), lambda p: p[field])
    joined = pieces.groupBy("conv_id").agg(
        F.first("gaps").alias("gaps"), *[F.sum(c).alias(c) for c in counts], F.first("illegal").alias("illegal"), F.first("cost").alias("cost"),
        F.array_join(told("letters"), "").alias("audit"), F.sha2(F.array_join(told("piece"), "\n"), 256).alias("repaired_sha256"))
    return whole.unionByName(joined)
