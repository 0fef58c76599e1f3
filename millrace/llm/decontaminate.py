"""Benchmark decontamination by edit distance: a random-walk embedding, bit sampling, exact check.

The CGK walk reads a string with one pointer that stays or moves on by a random
bit of (step, symbol).  Two strings under one walk agree in most outputs if
their edit distance is small, so edit distance becomes Hamming distance, and a
few sampled outputs make a hash that close strings share.  The walk is repeated
with other bits as often as a trial with the most edits allowed says is needed
for the target recall, in a trial for each class of item lengths.  Symbols are words.

A text is read in windows of every item length in use.  A window can only lie
within the allowed distance of an item if it begins with one of the item's first
words (the first that is kept) and holds enough of them, and enough pairs of neighbours (running counts tell) that
are of one and the same item, so other windows are never walked; no match is lost by that.  Windows that share a hash with an item are
compared by exact edit distance.  Lengths for which ``MOST_WALKS`` do not reach the
target are not walked: their windows are compared with every item of the length
that has the window's first word among its first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mixed

ALLOWED = 0.2
SAMPLED = 3
RECALL, MOST_WALKS, TRIALS = 0.98, 64, 400
#: Lengths of one class differ by less than this factor.
CLASS = 1.1
#: Bytes of benchmark text that tasks hold at once; a larger benchmark is taken in slices.
SLICE = 32 << 20
#: Numbers of walks that windows are walked in together; a window's hash in a walk does not depend on how many there are.
TIERS = (0, 8, 16, 32, MOST_WALKS)
#: Pairs of neighbours in more items than this count for every item.
COMMON = 64
#: Windows walked at once.
HELD = 4096
_EDGES = b".,;:!?\"'()[]{}"
_NONE = -1
#: More than the words of a slice of the benchmark.
PAIR = 1 << 31


def normal(word: bytes) -> bytes:
    return word.strip(_EDGES) or word


def allowed(length: int) -> int:
    return int(ALLOWED * length + 1e-9)


def edits(item: np.ndarray, text: np.ndarray) -> int:
    """The least edit distance of the item to a beginning of the text."""
    row = np.arange(len(text) + 1)
    steps = np.arange(len(text) + 1)
    for k, symbol in enumerate(item):
        best = np.empty_like(row)
        best[0] = k + 1
        best[1:] = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.minimum.accumulate(best - steps) + steps
    return int(row.min())


def symbol_hashes(symbols: np.ndarray) -> np.ndarray:
    return mixed((symbols + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def walk_hashes(symbols: np.ndarray, lengths: np.ndarray, walks: int, seed: int = 5) -> np.ndarray:
    """The sampled outputs of each walk over each row of symbols, as one number per row and walk.

    A row is read up to its length; outputs are sampled among as many steps, and
    rows of one length share the sample.
    """
    rng = np.random.default_rng(seed)
    shares = rng.random((walks, SAMPLED))
    taken = np.floor(shares[None] * lengths[:, None, None]).astype(np.int64)
    width = int(lengths.max(initial=1))
    coded = np.zeros((len(symbols), width + 1), np.uint64)
    coded[:, :width] = symbol_hashes(np.array([[_NONE]]))
    coded[:, : symbols.shape[1]] = symbol_hashes(symbols)
    coded[:, width] = 0
    rows, last = np.arange(len(symbols))[:, None], lengths[:, None]
    at = np.zeros((len(symbols), walks), np.int64)
    out = mixed((lengths[:, None] * 4096 + np.arange(walks)).astype(np.uint64))
    for step in range(int(taken.max()) + 1 if len(symbols) else 0):
        now = coded[rows, np.where(at < last, at, -1)]
        for k in range(SAMPLED):
            here = taken[:, :, k] == step
            if here.any():
                out[here] = mixed(out[here] * np.uint64(0x2545F4914F6CDD1D) + now[here] + np.uint64(k))
        at += (((now ^ mixed(np.arange(walks).astype(np.uint64) + np.uint64(step * 65536 + seed))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(np.int64)
    return out


@dataclass
class Index:
    """Items as word numbers, and which items have a hash.

    ``walks`` are by length; lengths with none have their items by (length, one of the first words) in ``heads``.
    """

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, np.ndarray]]
    lengths: list[int]
    pairs: np.ndarray
    firsts: np.ndarray
    walks: dict[int, int]
    table: dict[int, list[int]]
    heads: dict[tuple[int, int], list[int]]
    #: Of each pair the items that have it, one after another, from ``owner_starts`` on; and the lengths of items.
    owners: np.ndarray
    owner_starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, bytes | None]], seed: int = 11) -> Index:
        vocabulary: dict[bytes, int] = {}
        coded = []
        for item_id, text in items:
            words = [normal(w) for w in (text or b"").lower().split()]
            if words:
                coded.append((item_id, np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64)))
        lengths = np.array([len(s) for _, s in coded], np.int64)
        walks = cls._walks([s for _, s in coded], seed)
        table: dict[int, list[int]] = defaultdict(list)
        heads: dict[tuple[int, int], list[int]] = defaultdict(list)
        for many in sorted(set(walks.values())):
            mine = [k for k, (_, s) in enumerate(coded) if walks[len(s)] == many]
            for at in range(0, len(mine), 1024):
                some = mine[at : at + 1024]
                if many:
                    for k, hashes in zip(some, walk_hashes(padded([coded[k][1] for k in some]), lengths[some], many).tolist(), strict=True):
                        for h in hashes:
                            table[h].append(k)
                for k in [] if many else some:
                    symbols = coded[k][1]
                    for symbol in set(symbols[: allowed(len(symbols)) + 1].tolist()):
                        heads[len(symbols), symbol].append(k)
        own = [np.unique(s[:-1] * PAIR + s[1:]) for _, s in coded]
        every = np.concatenate([*own, np.empty(0, np.int64)])
        owners = np.repeat(np.arange(len(coded)), [len(x) for x in own])
        order = np.argsort(every, kind="stable")
        pairs, counts = np.unique(every, return_counts=True)
        owner_starts = np.concatenate([[0], np.cumsum(counts)])
        classes = sorted(set(lengths.tolist()))
        firsts = np.zeros((len(vocabulary) + 1, len(classes)), bool)
        for _, symbols in coded:
            firsts[symbols[: allowed(len(symbols)) + 1], classes.index(len(symbols))] = True
        return cls(vocabulary, coded, classes, pairs, firsts, walks, dict(table), dict(heads), owners[order], owner_starts, lengths)

    @classmethod
    def _walks(cls, items: list[np.ndarray], seed: int) -> dict[int, int]:
        """Walks for the target recall by length, from a trial of each class of lengths; none where the target is out of reach."""
        classes: dict[int, list[np.ndarray]] = defaultdict(list)
        for item in items:
            classes[int(np.log(len(item)) / np.log(CLASS))].append(item)
        out = {}
        for mine in classes.values():
            needed = cls._needed(mine, seed)
            out |= {len(item): needed for item in mine}
        return out

    @staticmethod
    def _needed(items: list[np.ndarray], seed: int) -> int:
        """Walks for the target recall, from items with the most edits allowed; 0 if ``MOST_WALKS`` do not reach it."""
        rng = np.random.default_rng(seed)
        some = [items[k] for k in np.resize(rng.permutation(len(items)), TRIALS)]
        others = []
        for item in some:
            changed = list(item)
            for _ in range(allowed(len(item))):
                kind, at = rng.integers(3), int(rng.integers(max(1, len(changed))))
                if kind == 0 and len(changed) > 1:
                    del changed[at]
                elif kind == 1:
                    changed.insert(at, 0)
                else:
                    changed[at] = 0
            others.append(np.array((changed + [_NONE] * len(item))[: len(item)], np.int64))
        lengths = np.array([len(x) for x in some], np.int64)
        for most in (MOST_WALKS // 2, MOST_WALKS):
            same = walk_hashes(padded(some), lengths, most) == walk_hashes(padded(others), lengths, most)
            met = np.logical_or.accumulate(same, 1).mean(0)
            if met[-1] >= RECALL:
                return int(np.argmax(met >= RECALL)) + 1
        return 0


def padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows), default=1)), _NONE, np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


class Codes(dict):
    """Numbers of words as they stand in texts, each looked up once."""

    LIMIT = 400_000

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        code = self[word] = self.vocabulary.get(normal(word), 0)
        return code


class Finder:
    """Matches of texts with the items of an index."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.codes = Codes(index.vocabulary)
        self.lengths = np.array(index.lengths, np.int64)
        self.edit = np.array([allowed(n) for n in index.lengths], np.int64)
        self.begins = index.firsts.any(axis=1)
        self.fewest = int((self.lengths - self.edit).min(initial=1 << 30))
        self.fewest_pairs = int((self.lengths - 1 - 2 * self.edit).min(initial=1 << 30))

    def coded(self, text: bytes | None) -> np.ndarray:
        if len(self.codes) > Codes.LIMIT:
            self.codes.clear()
        words = text.lower().split() if text else []
        return np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))

    def likely(self, symbols: np.ndarray) -> list[tuple[int, int]]:
        """(start, length) of the windows that can lie within the allowed distance of an item."""
        known = symbols > 0
        count = np.concatenate([[0], np.cumsum(known)])
        if count[-1] < self.fewest:
            return []
        both = np.flatnonzero(known[:-1] & known[1:])
        paired, which, places = np.zeros(len(symbols), np.int64), both[:0], both[:0]
        if len(self.index.pairs):
            codes = symbols[both] * PAIR + symbols[both + 1]
            at = np.minimum(np.searchsorted(self.index.pairs, codes), len(self.index.pairs) - 1)
            same = self.index.pairs[at] == codes
            paired[both] = same
            which, places = at[same], both[same]
        pairs = np.concatenate([[0], np.cumsum(paired)])
        if pairs[-1] < self.fewest_pairs:
            return []
        begins = np.flatnonzero(self.begins[symbols])
        at, kind = np.nonzero(self.index.firsts[symbols[begins]])
        at = begins[at]
        size, edit = self.lengths[kind], self.edit[kind]
        ends = np.minimum(at + size, len(symbols))
        enough = (count[ends] - count[at] >= size - edit) & (pairs[ends - 1] - pairs[at] >= size - 1 - 2 * edit)
        return self._of_one_item(at[enough], size[enough], edit[enough], places, which)

    def _of_one_item(self, at: np.ndarray, size: np.ndarray, edit: np.ndarray, places: np.ndarray, which: np.ndarray) -> list[tuple[int, int]]:
        """Those windows whose pairs (numbers ``which`` at ``places``) are enough for one item of the window's length."""
        if not len(at):
            return []
        starts = self.index.owner_starts
        many = starts[which + 1] - starts[which]
        common = many > COMMON
        many = np.where(common, 0, many)
        ends = np.concatenate([[0], np.cumsum(many)])
        owners = self.index.owners[np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[which], many)]
        lengths = self.index.sizes[owners]
        wild = np.concatenate([[0], np.cumsum(common)])
        low, high = np.searchsorted(places, at), np.searchsorted(places, at + size - 1)
        needed = size - 1 - 2 * edit - (wild[high] - wild[low])
        out = []
        for start, length, least, a, b in zip(at.tolist(), size.tolist(), needed.tolist(), ends[low].tolist(), ends[high].tolist(), strict=True):
            if least <= 0:
                out.append((start, length))
            elif b - a >= least:
                mine = owners[a:b][lengths[a:b] == length]
                if len(mine) >= least:
                    mine.sort()
                    # A run of ``least`` equal numbers.
                    if (mine[least - 1 :] == mine[: len(mine) - least + 1]).any():
                        out.append((start, length))
        return out

    def hits(self, texts: list[bytes | None]) -> list[list[int]]:
        """Per text (item_id, start word, distance) of each item found, its closest and first place, one after another."""
        found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        # Equal windows, of one text or several, are walked once; each text keeps its first.
        held: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        if self.index.items:
            for n, text in enumerate(texts):
                symbols = self.coded(text)
                for start, length in self.likely(symbols):
                    places = held.setdefault((length, symbols[start : start + length + allowed(length)].tobytes()), [])
                    if not places or places[-1][0] != n:
                        places.append((n, start))
                if len(held) >= HELD:
                    self._walk(held, found)
                    held = {}
            self._walk(held, found)
        ids = self.index.items
        order = lambda k: (ids[k][0] is None, ids[k][0] or 0, k)
        return [[x for k in sorted(f, key=order) for x in (ids[k][0], f[k][1], f[k][0])] for f in found]

    def _walk(self, held: dict[tuple[int, bytes], list[tuple[int, int]]], found: list[dict[int, tuple[int, int]]]) -> None:
        groups: dict[int, list[tuple[int, np.ndarray, list[tuple[int, int]]]]] = defaultdict(list)
        for (length, content), places in held.items():
            walks = self.index.walks[length]
            tier = next(t for t in TIERS if t >= walks)
            groups[tier].append((length, np.frombuffer(content, np.int64), places))
        for tier, mine in groups.items():
            if not tier:
                for length, text, places in mine:
                    self._compare(length, text, places, self.index.heads.get((length, int(text[0])), ()), found)
                continue
            for k in range(0, len(mine), HELD):
                some = mine[k : k + HELD]
                lengths = np.array([length for length, _, _ in some], np.int64)
                windows = padded([text[:length] for length, text, _ in some])
                for (length, text, places), hashes in zip(some, walk_hashes(windows, lengths, tier).tolist(), strict=True):
                    hashes = hashes[: self.index.walks[length]]
                    self._compare(length, text, places, {k for h in hashes for k in self.index.table.get(h, ())}, found)

    def _compare(
        self, length: int, text: np.ndarray, places: list[tuple[int, int]], items: Iterable[int], found: list[dict[int, tuple[int, int]]]
    ) -> None:
        edit = allowed(length)
        for k in items:
            item = self.index.items[k][1]
            if len(item) != length or np.isin(text, item).sum() < length - edit:
                continue
            distance = edits(item, text)
            if distance <= edit:
                for n, start in places:
                    if k not in found[n] or (distance, start) < found[n][k]:
                        found[n][k] = (distance, start)


def _searching(held):
    """The function that finds hits, as (item_id, start, distance) one after another."""

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(held.value)
        for texts in batches:
            yield pd.Series(finder.hits([bytes(t) if t is not None else None for t in texts]), dtype=object)

    return found


def with_hits(docs: DataFrame, benchmark: DataFrame, into: str = "hits") -> DataFrame:
    """The rows with array<struct<item_id,start,distance>>, the items found in the whole text.

    An item is found where its edit distance in words to a stretch of the text is
    at most a fifth of its length.  Words are compared in lower case (A-Z) without
    punctuation at their ends.  ``start`` counts words from 0.  Null and empty
    texts have no hits; items without words are never found.  Repeated items are
    each found; an item without an id is found under a null one.
    """
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = max(1, -(-size // SLICE))
    shape = "array<struct<item_id:bigint,start:bigint,distance:bigint>>"
    columns = []
    for part in range(slices):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == part).collect()
        held = docs.sparkSession.sparkContext.broadcast(Index.of([(r[0], bytes(r[1]) if r[1] is not None else None) for r in sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1] or b""))]))

        # Not to be evaluated once more for a filter that the optimizer derives.
        flat = F.pandas_udf(_searching(held), "array<bigint>").asNondeterministic()(F.col("text").cast("binary"))
        columns.append(flat)
    spare = "_hits"
    while spare in docs.columns:
        spare += "_"
    triples = F.transform(F.sequence(F.lit(0), (F.size(spare) / 3).cast("int") - 1), lambda k: F.struct(
        F.col(spare)[k * 3].alias("item_id"), F.col(spare)[k * 3 + 1].alias("start"), F.col(spare)[k * 3 + 2].alias("distance")))
    return docs.withColumn(spare, F.concat(*columns)).withColumn(
        into, F.when(F.size(spare) > 0, triples).otherwise(F.array().cast(shape))).drop(spare)
