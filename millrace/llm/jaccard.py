"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents of equal n-gram sets are one row of the incidence matrix.  A row
keeps only the entries that a partner above the threshold must touch: with its
n-grams in one fixed order, the first ``n - ceil(t n) + 1``.  The order puts
n-grams that are rare in the corpus first, by counts in a sketch of fixed size
over all documents, so frequent passages rarely stay.  The product of what is
left with its transpose counts overlaps; a pair goes on only if its count can
still reach the overlap that its sizes ask for, and then whole sets are
compared.

Only components are asked for, so large groups of copies need not be
multiplied out.  First products take neighbours within each column, in size
order and then in ``ROUNDS`` random orders, and of each document's neighbours in
other components the one met most often; the pairs that whole sets confirm join
components.  Each costs no more than the entries there are.  The last product
takes every pair of a column whose components still differ, in blocks of
``BLOCK`` by ``BLOCK`` entries, at the first columns that the two have in common only.  No pair is left out but those whose ends are known to be connected, or
whose sets differ in too many n-grams: each set has the parity of its n-grams in
``64 * MARKS`` bins, and bins of unlike parity hold one differing n-gram at least.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import mixed, shingles, stored, word_hashes, word_places
from millrace.llm.components import components

SIZE = 5
THRESHOLD = (80, 100)
BLOCK = 1024
#: Random orders in which neighbours are tried before all pairs are.
ROUNDS = 3
SKETCH_BITS = 21
#: Longs of a set's parity bins.
MARKS = 8
#: Entries before an entry that tell whether a pair has met already.
RECENT = 4
#: Counters of the sketch that are added up together.
SLICE = 1 << 16
_SHIFT = np.uint64(64 - SKETCH_BITS)

Batches = Iterator[pa.RecordBatch]


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("binary"))


def sets_of(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' sets of n-grams, each in order, one after the other, and where each ends, from 0."""
    data = b"\n".join(t or b"" for t in texts).lower()
    starts = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    padded = np.frombuffer(data + bytes(8), np.uint8)
    first, length = word_places(padded[: len(data)])
    ends = np.searchsorted(first, starts)
    words, many = word_hashes(padded, first, length), np.diff(ends)
    grams = np.where(many < size, np.minimum(many, 1), many - size + 1)
    bounds = np.concatenate([[0], np.cumsum(grams)])
    values, text = np.empty(bounds[-1], np.uint64), np.repeat(np.arange(len(texts)), grams)
    # A run that ends in another text is none.
    of_word, last = np.repeat(np.arange(len(texts)), many), max(0, len(words) - size + 1)
    values[(many >= size)[text]] = shingles(words, size)[:last][of_word[:last] == of_word[len(words) - last :]]
    for k in np.flatnonzero((many > 0) & (many < size)).tolist():
        values[bounds[k]] = shingles(words[ends[k] : ends[k + 1]], size)[0]
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[low:high].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(texts)))])


def nodes_of(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of sets of n-grams."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])[ends]
    return mixed(np.diff(sums) + np.diff(ends).astype(np.uint64)).view(np.int64)


def marks_of(values: np.ndarray, owner: np.ndarray | int = 0, many: int = 1) -> np.ndarray:
    """The parity of the n-grams in each of ``64 * MARKS`` bins, for each of the sets that own them."""
    width = 64 * MARKS
    bins = np.bincount((values & np.uint64(width - 1)).astype(np.int64) + owner * width, minlength=many * width)
    return np.packbits((bins & 1).astype(np.uint8)).view(np.int64)


def _profiles(size: int) -> Callable[[Batches], Batches]:
    """Per document: its set's name, size and parities; per task the slices of its sketch, with n = -1."""

    def run(batches: Batches) -> Batches:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = [f"m{k}" for k in range(MARKS)]
        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()), *((m, pa.int64()) for m in names)])
        for batch in batches:
            many = len(batch)
            values, ends = sets_of(batch.column(1).to_pylist(), size)
            sketch += np.bincount((values >> _SHIFT).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
            columns = marks_of(values, np.repeat(np.arange(many), np.diff(ends)), many).reshape(-1, MARKS).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes_of(values, ends)), pa.array(np.diff(ends)), pa.nulls(many, pa.binary()), *map(pa.array, columns)], schema=schema)
        slices = [part.tobytes() for part in sketch.reshape(-1, SLICE)]
        none = pa.nulls(len(slices), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array(range(len(slices)), pa.int64()), pa.array([-1] * len(slices), pa.int64()), pa.array(slices, pa.binary()), *[none] * MARKS], schema=schema)

    return run


def _added(key: tuple, batches: Batches) -> Batches:
    """The sum of one slice of all sketches."""
    total = np.zeros(SLICE, np.uint32)
    for batch in batches:
        for counts in batch.column(1).to_pylist():
            total += np.frombuffer(counts, np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["slice", "counts"])


def _prefixes(size: int, threshold: tuple[int, int], sketch) -> Callable[[Batches], Batches]:
    """The entries of each different document that a partner must touch."""
    over, of = threshold

    def run(batches: Batches) -> Batches:
        counts, seen = sketch.value, set()
        schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            values, ends = sets_of(batch.column(0).to_pylist(), size)
            # Each n-gram's count over its place, so that one sort orders a set.
            order = counts[(values >> _SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(32) | np.arange(len(values), dtype=np.uint64)
            bounds = ends.tolist()
            for node, low, high in zip(nodes_of(values, ends).tolist(), bounds[:-1], bounds[1:], strict=True):
                n = high - low
                if not n or node in seen:
                    continue
                seen.add(node)
                keep = n - -(-over * n // of) + 1
                order[low:high].sort()
                some = (order[low : low + keep] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                parts.append((values[some].view(np.int64), np.full(keep, node), np.full(keep, n, np.int32), np.arange(keep, dtype=np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=schema)

    return run


def _shared(batches: Batches) -> Batches:
    """Of rows sorted by n-gram and size: those whose n-gram others have too, each with its predecessor."""
    names = ("shingle", "node", "n", "place")
    schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()),
                        ("prev", pa.int64()), ("prev_n", pa.int32())])
    held: list[np.ndarray] | None = None
    for batch in chain(batches, [None]):
        if batch is None:
            if held is None:
                return
            columns, emit = held, len(held[0])
        else:
            if not batch.num_rows:
                continue
            new = [batch.column(k).to_numpy() for k in range(len(names))]
            columns = [np.concatenate(p) for p in zip(held, new, strict=True)] if held is not None else new
            emit = len(columns[0]) - 1
        s = columns[0]
        like = np.concatenate([[False], s[1:] == s[:-1], [False]])
        # The first row, if held back, was emitted as a predecessor's follower or not at all: two are held.
        first = 0 if held is None else len(held[0]) - 1
        rows = np.arange(first, emit)
        keep = rows[like[rows] | like[rows + 1]]
        if len(keep):
            before = np.maximum(keep - 1, 0)
            null = ~like[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep]) for c in columns] + [pa.array(columns[1][before], mask=null), pa.array(columns[2][before], mask=null)], schema=schema)
        held = [c[-2:] for c in columns]


def _needed(x: Column, y: Column, threshold: tuple[int, int]) -> Column:
    """The least overlap of two sets of these sizes above the threshold."""
    over, of = threshold
    return F.floor((over * (x + y) + (over + of - 1)) / (over + of))


def _can_reach(count: Column, x: Column, y: Column, threshold: tuple[int, int]) -> Column:
    """Whether ``count`` overlaps among kept entries leave the needed overlap in reach.

    All common n-grams up to the end of the kept entries of one of the two are
    counted; the others lie beyond it.
    """
    over, of = threshold
    beyond = lambda n: F.ceil(over * n / of) - 1
    return (of * x >= over * y) & (count + F.greatest(beyond(x), beyond(y)) >= _needed(x, y, threshold))


def _plausible(pairs: DataFrame, kept: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose kept entries have as many in common as their sizes ask for."""
    of = lambda end: kept.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("kept").alias(f"kept_{end}"))
    count = F.size(F.array_intersect("kept_a", "kept_b"))
    return pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").where(
        _can_reach(count, F.least("n_a", "n_b"), F.greatest("n_a", "n_b"), threshold)).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose whole sets pass the threshold."""
    over, of = threshold
    left = sets.select(F.col("node").alias("a"), F.col("values").alias("va"))
    right = sets.select(F.col("node").alias("b"), F.col("values").alias("vb"))
    common = F.size(F.array_intersect("va", "vb"))
    union = F.size("va") + F.size("vb") - F.col("common")
    return (
        pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", common)
        .where(of * F.col("common") >= over * union).select("a", "b")
    )


def _whole_sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The whole set of each of the nodes, from one document of each."""

    def run(batches: Batches) -> Batches:
        schema = pa.schema([("node", pa.int64()), ("values", pa.list_(pa.int64()))])
        for batch in batches:
            values, ends = sets_of(batch.column(0).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes_of(values, ends)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))], schema=schema)

    wanted = classes.join(nodes, "node", "left_semi").select(F.col("first_doc").alias("d")).distinct()
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("bytes")
    return texts.mapInArrow(run, "node long, values array<long>").dropDuplicates(["node"])


def _neighbours(shared: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """For each document the one of another part that stands before it most often, with columns in random order.

    Only columns with several parts count; long ones are cut into chunks of
    about ``BLOCK`` entries, others in each turn.
    """
    rows = shared.select("shingle", "node").join(parts.withColumnRenamed("root", "part"), "node")
    columns = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("part").alias("p0"), F.max("part").alias("p1")).where("p0 != p1")
    order = F.xxhash64("node", F.lit(turn))
    chunk = F.pmod(F.xxhash64("node", F.lit(-turn)), F.ceil(F.col("c") / BLOCK))
    dealt = rows.join(columns.select("shingle", "c"), "shingle").withColumns({"chunk": chunk, "order": order})
    before = Window.partitionBy("shingle", "chunk").orderBy("order")
    met = dealt.withColumns({"a": F.lag("node").over(before), "other": F.lag("part").over(before)}).where(F.col("other") != F.col("part"))
    counts = met.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("count"))
    return counts.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Parts (node, root) after their links: components of the roots, not of all documents again."""
    of = lambda end: parts.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
    roots = links.join(of("a"), "a").join(of("b"), "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    moved = components(roots).select(F.col("root").alias("to"), F.col("node").alias("root"))
    return stored(parts.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "jaccard-parts")


def _meetings(shared: DataFrame, parts: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) in different parts that have a kept n-gram in common early enough for the overlap that is needed; a few come more than once.

    At the first of its common n-grams a pair can still reach what it needs, so
    places behind that bound are not looked at.  Of a pair's other common n-grams
    most are known for later ones: each entry brings the ``RECENT`` before it,
    and two entries with one of these in common have met there or earlier.
    """
    marks = [f"m{k}" for k in range(MARKS)]
    entries = shared.select("shingle", "node", "n", "place").join(parts.withColumnRenamed("root", "part"), "node")
    mixed_columns = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("part").alias("p0"), F.max("part").alias("p1")).where("p0 != p1")
    before = Window.partitionBy("node").orderBy("place").rowsBetween(-RECENT, -1)
    rows = entries.join(mixed_columns.select("shingle", "c"), "shingle").withColumn("recent", F.collect_list("shingle").over(before))
    rows = stored(rows.join(classes.select("node", *marks), "node"), "product-rows")
    ranked = rows.where(F.col("c") > BLOCK).withColumn(
        "block", F.floor((F.row_number().over(Window.partitionBy("shingle").orderBy("n", "node")) - 1) / BLOCK))
    blocks = F.ceil(F.col("c") / BLOCK)
    few = rows.where(F.col("c") <= BLOCK).withColumn("block", F.lit(0).cast("long"))
    rows = few.unionByName(ranked)
    left = rows.withColumn("other", F.explode(F.sequence(F.col("block"), blocks - 1))).select(
        "shingle", F.col("block").alias("i"), F.col("other").alias("j"), F.col("node").alias("a"), F.col("n").alias("x"), F.col("place").alias("px"), F.col("part").alias("pa"), F.col("recent").alias("ra"), *[F.col(m).alias(f"a{m}") for m in marks])
    right = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block")))).select(
        "shingle", F.col("other").alias("i"), F.col("block").alias("j"), F.col("node").alias("b"), F.col("n").alias("y"), F.col("place").alias("py"), F.col("part").alias("pb"), F.col("recent").alias("rb"), *[F.col(m).alias(f"b{m}") for m in marks])
    over, of = threshold
    x, y = F.col("x"), F.col("y")
    most = F.least(x - F.col("px"), y - F.col("py"))
    differ = sum((F.bit_count(F.col(f"a{m}").bitwiseXOR(F.col(f"b{m}"))) for m in marks), F.lit(0))
    pairs = left.join(right, ["shingle", "i", "j"]).where(
        ((x < y) | ((x == y) & (F.col("a") < F.col("b")))) & (F.col("pa") != F.col("pb"))
        & (of * x >= over * y) & (most >= _needed(x, y, threshold)) & (differ <= x + y - 2 * _needed(x, y, threshold))
        & ~F.arrays_overlap("ra", "rb"))
    return pairs.select("a", "b")


def near_duplicates(docs: DataFrame, size: int = SIZE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, component_size in rows, and root.

    Two documents are linked when their sets of ``size``-word n-grams have a
    Jaccard similarity of ``threshold`` (a fraction) or more; a text of fewer
    words is one n-gram.  ``component_id`` is the smallest doc_id reachable by
    links, itself included.  Null, empty and blank texts have no n-grams and are
    linked with nothing.  Repeated rows are linked with one another like any
    copies.  A null doc_id never is the smallest but where there is no other.
    ``root`` names the component even where ids repeat or are null, and is null
    without n-grams; doc_id and ``text_hash`` lead back to the document.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("bytes"), text_hash().alias("text_hash"))
    marks = [f"m{k}" for k in range(MARKS)]
    profiles = stored(docs.mapInArrow(_profiles(size), "doc_id long, text_hash long, node long, n long, counts binary, " + ", ".join(f"{m} long" for m in marks)), "jaccard-profiles")
    summed = profiles.where("n < 0").select(F.col("node").alias("slice"), "counts").groupBy("slice").applyInArrow(_added, "slice long, counts binary")
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for k, counts in summed.collect():
        sketch[k * SLICE : (k + 1) * SLICE] = np.frombuffer(counts, np.uint32)
    held = spark.sparkContext.broadcast(sketch)
    rows = profiles.where("n >= 0").drop("counts")
    classes = stored(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("rows"), *[F.first(m).alias(m) for m in marks]), "jaccard-classes")
    shared = stored(
        docs.select("bytes").mapInArrow(_prefixes(size, threshold, held), "shingle long, node long, n int, place int")
        .repartition("shingle").dropDuplicates(["shingle", "node"]).sortWithinPartitions("shingle", "n", "node")
        .mapInArrow(_shared, "shingle long, node long, n int, place int, prev long, prev_n int"),
        "jaccard-shared",
    )
    def confirmed(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return stored(_linked(pairs, _whole_sets(docs, ends, classes, size), threshold), "jaccard-links")

    kept = stored(shared.groupBy("node").agg(F.first("n").alias("n"), F.collect_list("shingle").alias("kept")), "jaccard-kept")
    parts = kept.select("node", F.col("node").alias("root"))
    pairs = shared.where("prev is not null").groupBy(F.col("prev").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("count"))
    pairs = pairs.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))
    for turn in range(1, ROUNDS + 2):
        likely = stored(_plausible(pairs, kept, threshold), "jaccard-likely")
        if likely.isEmpty() and turn > 1:
            break
        parts = _joined(parts, confirmed(likely))
        pairs = _neighbours(shared, parts, turn)
    last = stored(_plausible(_meetings(shared, parts, classes, threshold).distinct(), kept, threshold), "jaccard-last")
    if not last.isEmpty():
        parts = _joined(parts, confirmed(last))
    named = classes.select("node", "first_doc", "rows").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"), F.sum("rows").alias("component_size"))
    named = stored(named.select("node", "root").join(least, "root").select("node", "root", "component_id", "component_size"), "jaccard-named")
    some = rows.where("n > 0").select("doc_id", "text_hash", "node", "n").join(named, "node").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "component_size", "root")
    none = rows.where("n = 0").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("component_size"),
        F.lit(None).cast("long").alias("root"))
    return some.unionByName(none)
