"""Phrase collocation mining by direct-address tiling.

Words are ranked by frequency.  The ``HEAD`` most frequent ones have the same
number in every task; others are numbered as a task meets them.  A pair of
numbers is a cell of a square table cut into tiles: a tile that many pairs fall
into is counted by a dense ``bincount``, the rest as sorted coordinates.  The
pairs frequent enough are ranked in turn and take the place of words, so that
pair and next word make the table of three-word phrases, and so on.

Tasks add their counts up per buffer of ``BUFFER`` pairs, Spark adds these up.
A pair with a rare part is rare, so tasks leave out parts that no bit of a
bitmap of fixed size (made from the hashes of all frequent parts) names; a bit
set by chance costs a count, never a phrase.  No table is held whole anywhere:
the head is ``HEAD`` rows and the bitmap ``1 << BITS`` bits at any input size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import mixed, stored

LEAST, WORDS, TOP, COVERED = 10, 3, 2000, 50
HEAD, TILE, NEAR, BUFFER, BITS = 1 << 16, 1 << 10, 1 << 6, 1 << 21, 24
#: Words a task numbers or counts before it hands its counts on.
HELD = 1 << 18
_NO_LANG = "und"

# One table for bytes: A-Z in lower case, ends of pieces as line feeds, tabs as spaces.
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_END = b"\n"

Batches = Iterator[pa.RecordBatch]


def pieces_of(text: bytes | None) -> list[bytes]:
    """The words of a text in order, with a line feed between pieces (and empty words, to be skipped)."""
    return (text or b"").translate(_BYTES).replace(b"\n", b" \n ").split(b" ")


def code_of(lang: str, word: bytes) -> int:
    """The code of a word of a language beyond the head: a hash, below zero.  Words of the head have their rank."""
    return (xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang)) >> 1) - (1 << 63)


def bit_of(codes: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit of a phrase in the bitmap, from the codes of its words."""
    value = np.full(len(codes[0]), len(codes), np.uint64)
    for code in codes:
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + code.view(np.uint64))
    return (value >> np.uint64(64 - bits)).astype(np.int64)


def count_tiles(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of numbers and how often each occurs.

    Tiles near the origin with a pair for every fourth cell or more are counted
    densely: numbers are ranks, so heavy tiles lie there.
    """
    row, column, times = first // TILE, second // TILE, []
    near = (row < NEAR) & (column < NEAR)
    tile = np.where(near, row * NEAR + column, NEAR * NEAR)
    heavy = np.flatnonzero(np.bincount(tile, minlength=1)[: NEAR * NEAR] >= TILE * TILE // 4)
    cells_of, sparse = [], np.ones(len(first), bool)
    for k in heavy.tolist():
        here = tile == k
        sparse[here] = False
        top, left = k // NEAR * TILE, k % NEAR * TILE
        cells = np.bincount((first[here] - top) * TILE + second[here] - left, minlength=TILE * TILE)
        filled = np.flatnonzero(cells)
        cells_of.append((top + filled // TILE) << 32 | (left + filled % TILE))
        times.append(cells[filled])
    cells, n = np.unique(first[sparse] << 32 | second[sparse], return_counts=True)
    cells, n = np.concatenate([*cells_of, cells]), np.concatenate([*times, n])
    return cells >> 32, cells & 0xFFFFFFFF, n


def _word_counts(batches: Batches) -> Batches:
    names, counts = ["lang", "word", "n"], {}

    def out() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, per in counts.items() for word, n in per.items() if word and word != _END]
        counts.clear()
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        kinds = [pa.string(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(pieces_of(text))
        if sum(map(len, counts.values())) > HELD:
            yield out()
    yield out()


class Model:
    """What tasks need of the phrases one word shorter: bounded by ``HEAD`` and ``BITS``."""

    def __init__(self, words: list[tuple[str, bytes]], bitmaps: list[np.ndarray], pairs: list[np.ndarray] | None, bits: int):
        self.words, self.bitmaps, self.pairs, self.bits = words, bitmaps, pairs, bits
        self._head: tuple[dict, list, list] | None = None

    def head(self) -> tuple[dict[str, dict[bytes, int]], list[int], list[str]]:
        """Numbers of the head by language, and its codes and languages by number; made once a worker."""
        if self._head is None:
            langs: dict[str, dict[bytes, int]] = {}
            for number, (lang, word) in enumerate(self.words):
                langs.setdefault(lang, {_END: -1})[word] = number
            self._head = langs, list(range(len(self.words))), [lang for lang, _ in self.words]
        return self._head

    def named(self, codes: list[np.ndarray]) -> np.ndarray:
        """Whether the bitmap of phrases of this length names each phrase."""
        bit = bit_of(codes, self.bits)
        return (self.bitmaps[len(codes) - 1][bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def _coded(model: Callable[[], Model]) -> Callable[[Batches], Batches]:
    """Adds the code of each word."""

    def run(batches: Batches) -> Batches:
        langs, _, _ = model().head()
        for batch in batches:
            codes = [langs.get(lang, {}).get(word) for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = zip(codes, batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            whole = [code_of(lang, word) if code is None else code for code, lang, word in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.int64()), batch.column(1).cast(pa.string()), batch.column(2)],
                                             names=["lang", "w0", "word", "n"])

    return run


class _Numbers:
    """Numbers of words in a task: those of the head are ranks, others by first use; -1 for rare ones."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        langs, codes, lang_of = self.model.head()
        self.langs = {lang: dict(numbers) for lang, numbers in langs.items()}
        self.codes, self.lang_of = list(codes), list(lang_of)

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.langs.setdefault(lang, {_END: -1})
        new = [word for word in dict.fromkeys(words) if word not in known]
        if new:
            codes = np.array([code_of(lang, word) for word in new], np.int64)
            for word, code, kept in zip(new, codes.tolist(), self.model.named([codes]).tolist(), strict=True):
                known[word] = len(self.codes) if kept else -1
                if kept:
                    self.codes.append(code)
                    self.lang_of.append(lang)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def full(self) -> bool:
        return sum(map(len, self.langs.values())) > len(self.model.words) + HELD


def _phrase_counts(size: int, model: Callable[[], Model]) -> Callable[[Batches], Batches]:
    """Counts of the phrases of ``size`` words in the texts of a task, from the model of shorter ones."""

    def run(batches: Batches) -> Batches:
        numbers, buffer, held = _Numbers(model()), [], 0
        names = ["lang", *[f"w{k}" for k in range(size)], "n"]
        schema = pa.schema([("lang", pa.string()), *[(name, pa.int64()) for name in names[1:]]])

        def out() -> pa.RecordBatch:
            nonlocal held
            run_of, codes = np.concatenate(buffer), np.array(numbers.codes, np.int64)
            at = np.flatnonzero(_all(run_of, size))
            if size > 2:
                # Every shorter phrase inside must be frequent: parts are looked up by their words' codes.
                for start in range(2):
                    words = [codes[run_of[at + start + k]] for k in range(size - 1)]
                    at = at[numbers.model.named(words)]
            first = run_of[at]
            parts = first[:, None]
            if size > 2:
                first, parts = _ranked(run_of, at, size - 1, codes, numbers.model.pairs)
            one, two, times = count_tiles(first, run_of[at + size - 1])
            if size > 2:
                heads = parts[np.searchsorted(parts[:, 0], one), 1:]
            else:
                heads = one[:, None]
            lang = pa.DictionaryArray.from_arrays(*_lang_of(numbers.lang_of, heads[:, 0])).cast(pa.string())
            columns = [lang, *[pa.array(codes[heads[:, k]]) for k in range(size - 1)], pa.array(codes[two]), pa.array(times.astype(np.int64))]
            buffer.clear()
            held = 0
            if numbers.full():
                numbers.reset()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [word for word in pieces_of(text) if word]
                if words:
                    buffer.append(np.append(numbers.of(lang, words), -1))
                    held += len(words)
                if held >= BUFFER:
                    yield out()
        if buffer:
            yield out()

    return run


def _all(run_of: np.ndarray, size: int) -> np.ndarray:
    """Where ``size`` numbered words stand in a row."""
    total = max(len(run_of) - size + 1, 0)
    kept = np.ones(total, bool)
    for k in range(size):
        kept &= run_of[k : k + total] >= 0
    return kept


def _ranked(run_of: np.ndarray, at: np.ndarray, size: int, codes: np.ndarray, head: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the phrases of ``size`` words at these places, and a table of number and words, sorted.

    Phrases of the head have their rank, others follow in order of their words.
    """
    number, table = run_of[at], None
    for k in range(1, size):
        cells, number = np.unique(number << 32 | run_of[at + k], return_inverse=True)
        left = cells >> 32
        table = np.column_stack([left[:, None] if table is None else table[left], cells & 0xFFFFFFFF])
    if table is None:
        table = np.empty((0, size), np.int64)
    rank = np.arange(len(table)) + len(head[0])
    if len(table) and len(head[0]):
        # The head by the bit hash at full width, checked word by word.
        keys, own = bit_of(head, 63), bit_of([codes[table[:, k]] for k in range(size)], 63)
        order = np.argsort(keys, kind="stable")
        place = order[np.minimum(np.searchsorted(keys[order], own), len(order) - 1)]
        same = np.logical_and.reduce([head[k][place] == codes[table[:, k]] for k in range(size)])
        rank[same] = place[same]
    order = np.argsort(rank)
    return rank[number], np.column_stack([rank[order], table[order]])


def _lang_of(langs: list[str], numbers: np.ndarray) -> tuple[pa.Array, pa.Array]:
    names = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
    own = np.fromiter(map(names.__getitem__, langs), np.int32, len(langs))
    return pa.array(own[numbers]), pa.array(list(names), pa.string())


def _bitmap(phrases: DataFrame, size: int, bits: int) -> np.ndarray:
    """The bits of all phrases as bytes: 1 << bits of them, whatever the number of phrases."""
    names = [f"w{k}" for k in range(size)]

    def bit(batches: Batches) -> Batches:
        for batch in batches:
            codes = [np.asarray(batch.column(k), np.int64) for k in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array(bit_of(codes, bits))], names=["bit"])

    made = phrases.select(*names).mapInArrow(bit, "bit long")
    # bitmap_construct_agg makes pieces of 32,768 bits; piece 0 has bit 0 alone, piece k the bits from 32,768 (k - 1) + 1 on.
    rows = made.groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
    whole = np.zeros(((1 << bits) // 32768 + 2) * 32768, np.uint8)
    for row in rows.toLocalIterator():
        start = max((row["bucket"] - 1) * 32768 + 1, 0)
        piece = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        whole[start : start + len(piece)] |= piece
    return np.packbits(whole, bitorder="little")


def _product(one: Column, two: Column) -> Column:
    return one.cast("decimal(19,0)") * two.cast("decimal(19,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals: counts up to 1e15 stay exact."""
    whole = (F.lit(1_000_000).cast("decimal(7,0)") * a.cast("decimal(15,0)")).cast("decimal(22,0)") * a.cast("decimal(15,0)")
    return F.call_function("div", whole, _product(left, right))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, head: int = HEAD, bits: int = BITS) -> DataFrame:
    """The best scored phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs``: lang (null: ``und``) and text (null: empty); other columns are
    ignored.  Pieces end at ``.,;:!?`` and at line ends; a phrase lies within a
    piece.  ``a``, ``l`` and ``r`` count the phrase and the two parts of its
    lowest-scoring cut (ties: the first), ``n`` all words of the language.
    Phrases below ``least`` are no candidates, and one that a longer candidate
    holds with ``covered`` percent of its count or more is dropped.  Rows that
    repeat count again.  A language without candidates has no rows, nor has an
    empty table.  Neither ``head`` nor ``bits`` changes any result.
    """
    texts = docs.select(F.coalesce("lang", F.lit(_NO_LANG)).alias("lang"), F.col("text").cast("binary").alias("text")).where("text is not null")
    context = docs.sparkSession.sparkContext
    counted = texts.mapInArrow(_word_counts, "lang string, word binary, n long")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least)
    best = frequent.orderBy(F.desc("n"), "lang", "word").limit(head).select("lang", "word").collect()
    model = Model([(row["lang"], bytes(row["word"])) for row in best], [], None, bits)
    shared = context.broadcast(model)
    words = stored(frequent.mapInArrow(_coded(lambda: shared.value), "lang string, w0 long, word string, n long"), "words")
    shared.destroy()
    model = Model(model.words, [_bitmap(words, 1, bits)], None, bits)

    tables = [words]
    for size in range(2, WORDS + 1):
        shared = context.broadcast(model)
        names = [f"w{k}" for k in range(size)]
        schema = f"lang string, {', '.join(f'{name} long' for name in names)}, n long"
        made = texts.mapInArrow(_phrase_counts(size, lambda shared=shared: shared.value), schema)
        frequent = stored(made.groupBy("lang", *names).agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"phrases-{size}")
        shared.destroy()
        tables.append(frequent)
        if size < WORDS:
            ranked = frequent.orderBy(F.desc("n"), "lang", *names).limit(head).select(*names).toArrow()
            heads = [ranked.column(k).to_numpy() for k in range(size)]
            model = Model(model.words, [*model.bitmaps, _bitmap(frequent, size, bits)], heads, bits)
    return _best(tables, total, top, covered)


def _counts_of(table: DataFrame, size: int, start: int, to: str) -> DataFrame:
    """Counts of shorter phrases, keyed as the words from ``start`` on of a longer one."""
    return table.select("lang", *[F.col(f"w{k}").alias(f"w{start + k}") for k in range(size)], F.col("n").alias(to))


def _best(tables: list[DataFrame], total: DataFrame, top: int, covered: int) -> DataFrame:
    candidates = []
    for size in range(2, len(tables) + 1):
        names, phrases = [f"w{k}" for k in range(size)], tables[size - 1].withColumnRenamed("n", "a")
        cuts = []
        for k in range(1, size):
            left, right = _counts_of(tables[k - 1], k, 0, f"l{k}"), _counts_of(tables[size - k - 1], size - k, k, f"r{k}")
            phrases = phrases.join(left, ["lang", *names[:k]]).join(right, ["lang", *names[k:]])
            score = _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        if size < len(tables):
            # The largest count of a longer candidate that holds the phrase; its own parts hold those of the next size.
            longer = [t.select("lang", *[F.col(f"w{j + s}").alias(f"w{j}") for j in range(size)], "n")
                      for length, t in enumerate(tables[size:], size + 1) for s in range(length - size + 1)]
            held = longer[0]
            for more in longer[1:]:
                held = held.unionByName(more)
            held = held.groupBy("lang", *names).agg(F.max("n").alias("held"))
            phrases = phrases.join(held, ["lang", *names], "left_outer").where(
                F.col("held").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("held") < F.lit(covered).cast("decimal(3,0)") * F.col("a")))
        cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        phrases = phrases.withColumn("cut", cut)
        for k in range(size):
            phrases = phrases.join(tables[0].select("lang", F.col("w0").alias(f"w{k}"), F.col("word").alias(f"word{k}")), ["lang", f"w{k}"])
        candidates.append(phrases.select(
            "lang", F.concat_ws(" ", *[f"word{k}" for k in range(size)]).alias("phrase"), "a",
            F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score")))
    every = candidates[0]
    for more in candidates[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
