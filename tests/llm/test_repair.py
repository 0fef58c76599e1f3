from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from millrace.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(kinds: bytes, start: int = 0, goals=(0, 3), tail: bool = True):
    """Least (cost, letters) by trying all edits, with inserts of up to two turns before each."""

    def insert(state):
        return 3 if state == 2 else 2

    @cache
    def best(i, state, inserted):
        found = []
        if i == len(kinds):
            if state in goals:
                found.append((0, ""))
            if not tail:
                return min(found, default=None)
        if inserted < 2:
            rest = best(i, insert(state), inserted + 1)
            if rest:
                found.append((rest[0] + 5, "I" + rest[1]))
        if i < len(kinds):
            kind = kinds[i]
            ways = [("D", 2, state)]
            if kind != 8:
                role, extra = kind // 2, 5 * (kind % 2)
                if (role, state) in {(0, 0), (1, 0), (1, 1), (1, 3), (2, 2)}:
                    ways.append(("K", extra, {0: 1, 1: 2, 2: 3}[role]))
                ways.append(("R", 1 + extra, insert(state)))
            for letter, cost, then in ways:
                rest = best(i + 1, then, 0)
                if rest:
                    found.append((rest[0] + cost, letter + rest[1]))
        return min(found, default=None)

    return best(0, start, 0)


def test_search_equals_trying_everything():
    draw = random.Random(3)
    for _ in range(1500):
        kinds = bytes(draw.choices(range(9), [3, 1, 6, 2, 6, 2, 1, 1, 2], k=draw.randrange(0, 9)))
        assert repair.cheapest(kinds) == plain(kinds), kinds
        start, goal = draw.randrange(4), draw.randrange(4)
        assert repair.cheapest(kinds, start, (goal,), False) == plain(kinds, start, (goal,), False), (kinds, start, goal)


def test_long_conversations_are_searched_in_little_time():
    draw = random.Random(5)
    kinds = bytes(draw.choices([2, 4, 3, 5, 8, 6], k=3000))
    assert repair.cheapest(kinds)[0] > 1000


def test_known_repairs():
    u, a, s, cut = 2, 4, 0, 5
    assert repair.cheapest(bytes([s, u, a])) == (0, "KKK")
    assert repair.cheapest(bytes([a, u])) == (2, "RR")
    assert repair.cheapest(bytes([u])) == (2, "D")
    assert repair.cheapest(bytes([u, cut])) == (4, "DD")
    assert repair.cheapest(b"") == (0, "")


def rows_of(draw: random.Random, convs):
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No!", "open", " ", "", None, "Größe?", "a\nb."]
    return [(c, draw.choice([t, t, None]), draw.choice(roles), draw.choice(texts)) for c in convs for t in range(draw.randrange(0, 9))]


def expected(rows):
    """The whole result from plain loops over the damaged rows."""
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        kept = by_conv.setdefault(conv, [])
        if harm == 1:
            text = ""
        elif harm == 2:
            text = "".join(ch for ch in text if ch not in ".!?")
        elif harm == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1))
    out = []
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, faults = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            place = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            kinds.append(8 if fault in (0, 1) else place * 2 + (fault == 2))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, letters = plain(bytes(kinds))
        lines, k, led = [], 0, False
        for e in letters:
            if e != "D":
                role = kept[k][1] if e == "K" else ("user", "assistant")[(len(lines) - led) % 2]
                led = led or (e == "K" and role[:1] == "s")
                lines.append(f"{role}:{'' if e == 'I' else kept[k][2]}")
            k += e != "I"
        out.append((conv, gaps, *faults, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("block", [3, 1024])
def test_repair_equals_plain_loops(text_spark, rows, block):
    draw = random.Random(block)
    table = rows_of(draw, [None, *range(60)]) + rows_of(draw, [7] * 8 + [None] * 4)
    turns = text_spark.createDataFrame(table, SCHEMA).withColumn("said", F.lit(1)).repartition(5)
    got = repair.repair(repair.damage(turns), block).select(*COLUMNS)
    assert rows(got) == expected(table)


def test_empty_table_and_dropped_conversations(text_spark, rows):
    assert repair.repair(repair.damage(text_spark.createDataFrame([], SCHEMA))).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    turns = text_spark.createDataFrame([(1, 0, "user", "x.", True, 1)], SCHEMA + ", dropped boolean, copies int")
    assert rows(repair.repair(turns).select(*COLUMNS)) == [(1, 0, 0, 0, 0, 0, 0, "", empty)]
