"""Mixing sources to target weights by Pivotal dependent rounding.

Every document of a source is due the same fractional number of copies, the
source's target over its size.  The whole part is given at once.  The
fractional parts are rounded together: two documents are paired, and words are
moved from one to the other, in a random direction, until one of the two has a
whole number of copies.  What is due in all stays the same at every step, so a
source ends within part of one document of its target, and each document's
expected number of copies is what it is due.

The pairs form a tree.  Documents of a source are dealt by hash into buckets of
about ``BUCKET``; each bucket ends with one document that is still fractional;
those go on to the next level, where there are a ``BUCKET``-th as many.  A
source with a third of all rows is thus split over its buckets, and no task
sees more than a bucket of it at a time.

The document left at a source's root may be a long one, and rounding it leaves
words over or short.  These are carried on from long to short texts: of each
size class (a factor of two) at most ``CARRIERS`` documents may give or take
one copy.  Where sizes have gaps that is not enough; then as many more as the
words that are left ask for do, so these are less than a short text in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stored, text_or_empty

BUCKET = 16
CAP = 3
CARRIERS = 2
WEIGHTS = (1, 2, 3)
NEARLY = 1e-9


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Per source of (source, source_size): the words its mix is to have.

    Sources in code-point order, null last, take the weights in turn and share
    the total size.  A target stops at ``cap`` times its source's size; what is
    over goes to the others by weight, until none is above.  That end is reached
    in one step: it is ``min(cap * size, level * weight)`` for the one level at
    which the targets add up, found among the levels at which the sources that
    fill first are full.  One row per source; the window runs over these only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    fuller = F.coalesce(F.sum("most").over(by_room), F.lit(0.0))
    heavier = F.coalesce(F.sum("weight").over(by_room), F.lit(0.0))
    return (
        sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1))
        .withColumn("most", F.col("source_size") * float(cap))
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(every) - fuller) / (F.sum("weight").over(every) - heavier))
        .withColumn("level", F.max("level").over(every))
        .withColumn("target", F.least(F.col("most"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def _paired(items: Column, seed: int) -> Column:
    """Fold fractional documents pairwise: (left: the one still fractional, done: those rounded)."""
    kind = "struct<doc_id:bigint,size:bigint,rows:bigint,whole:bigint,part:double>"
    start = F.struct(
        F.lit(None).cast(kind).alias("left"),
        F.lit(None).cast(f"array<{kind}>").alias("done"),
    )

    def with_part(item: Column, part: Column) -> Column:
        return F.struct(item["doc_id"].alias("doc_id"), item["size"].alias("size"), item["rows"].alias("rows"),
                        item["whole"].alias("whole"), part.alias("part"))

    def step(state: Column, b: Column) -> Column:
        a = state["left"]
        ratio = b["size"] / a["size"]
        up = F.least(1 - a["part"], b["part"] * ratio)
        down = F.least(a["part"], (1 - b["part"]) * ratio)
        draw = F.pmod(F.xxhash64(F.lit(seed), a["doc_id"], a["size"], b["doc_id"], b["size"]), F.lit(1 << 30)) / float(1 << 30)
        rise = draw * (up + down) < down
        a_ends = F.when(rise, 1 - a["part"] <= b["part"] * ratio).otherwise(a["part"] <= (1 - b["part"]) * ratio)
        a_end = F.when(rise, 1.0).otherwise(0.0)
        moved = F.when(rise, up).otherwise(-down)
        within = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
        left = F.when(a_ends, with_part(b, within(b["part"] - moved / ratio))).otherwise(
            with_part(a, within(a["part"] + moved)))
        done = F.when(a_ends, with_part(a, a_end)).otherwise(with_part(b, 1 - a_end))
        none = F.lit(None).cast(f"array<{kind}>")
        return F.when(
            a.isNull(), F.struct(with_part(b, b["part"]).alias("left"), none.alias("done"))
        ).otherwise(
            F.struct(left.alias("left"), F.concat(F.coalesce(state["done"], F.array().cast(f"array<{kind}>")),
                                                  F.array(done)).alias("done"))
        )

    return F.aggregate(items, start, step)


def _carried(units: DataFrame, cap: int, seed: int, carriers: int | Column = CARRIERS) -> DataFrame:
    """Rounded documents with the words a source is over or short given to few others, from long to short.

    Of each source and size class the first ``carriers`` documents in hash order
    that can take (or give) a copy are asked, the longest first; one is taken if
    it does not overshoot.  No copies pass 0 or ``cap``, and a document that is
    ``moved`` already is not asked.
    """
    words = F.col("copies") * F.col("size")
    rest = units.groupBy(F.col("source").alias("of")).agg((F.first("target") - F.sum(words)).alias("rest"))
    able = units.join(rest, F.col("source").eqNullSafe(F.col("of"))).where(
        ~F.col("moved") & (F.col("size") > 0) & (F.col("size") <= F.abs("rest"))
        & F.when(F.col("rest") > 0, F.col("copies") < cap * F.col("rows")).otherwise(F.col("copies") > 0))
    order = Window.partitionBy("of", F.floor(F.log2("size"))).orderBy(F.xxhash64(F.lit(seed), "doc_id", "size"), "doc_id", "size")
    few = able.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= carriers)
    asked = few.groupBy("of").agg(F.first("rest").alias("rest"), F.sort_array(F.collect_list(F.struct("size", "doc_id")), asc=False).alias("asked"))
    kind = "array<struct<size:bigint,doc_id:bigint>>"

    def step(state: Column, item: Column) -> Column:
        fits = item["size"] <= state["left"]
        return F.struct(
            F.when(fits, state["left"] - item["size"]).otherwise(state["left"]).alias("left"),
            F.when(fits, F.concat(state["taken"], F.array(item))).otherwise(state["taken"]).alias("taken"))

    start = F.struct(F.abs("rest").alias("left"), F.array().cast(kind).alias("taken"))
    moved = asked.select("of", F.signum("rest").cast("long").alias("sign"), F.explode(F.aggregate("asked", start, step, lambda s: s["taken"])).alias("item")).select(
        "of", "sign", F.col("item.size").alias("s"), F.col("item.doc_id").alias("d"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d"))
    return units.join(moved, same, "left").withColumns({
        "copies": F.col("copies") + F.coalesce("sign", F.lit(0)), "moved": F.col("moved") | F.col("sign").isNotNull()}).drop("of", "sign", "s", "d")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document, at most ``cap`` times
    (targets do not pass ``cap`` times their source), ``taken`` the words.
    Repeated rows (same id, source and size) are rounded as one and then share
    their copies, the first rows one more.  Documents without words, and null
    texts, have size 0 and 0 copies; a null source is a source; null ids count as
    equal.  An empty table gives an empty table.  The draw depends on ids, sizes
    and the seed alone, so reruns agree.  The one document per source left
    fractional at the root goes to the nearer whole number, and a few shorter
    documents make up for it.
    """
    units = stored(
        docs.select("doc_id", "source", word_count().alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")),
        "mix-units",
    )
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                        F.count(F.lit(1)).alias("n"))
    targets = source_targets(sizes.select("source", "source_size"), weights, cap)
    about = targets.alias("t").join(sizes.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))).select(
        F.col("t.source").alias("of"), "t.source_size", "target", "n")
    due = F.when(F.col("size") > 0, F.col("target") / F.col("source_size") * F.col("rows")).otherwise(0.0)
    rows = (
        units.join(about, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("due", due)
        .withColumn("whole", F.floor(F.col("due") + NEARLY))
        .withColumn("part", F.greatest(F.lit(0.0), F.col("due") - F.col("whole")))
    )
    rows = stored(rows.drop("due"), "mix-due")
    fixed = rows.where(F.col("part") <= NEARLY).select(
        "source", "source_size", "target", "doc_id", "size", "rows", "whole", F.lit(0.0).alias("part"))
    item = F.struct("doc_id", "size", "rows", "whole", "part")
    level = rows.where(F.col("part") > NEARLY).select(
        "source", "source_size", "target", "n", item.alias("item"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    finished, depth = [fixed], 0
    while True:
        buckets = F.ceil(F.col("n") / BUCKET).cast("long")
        key = F.xxhash64(F.lit(seed + depth), F.col("item.doc_id"), F.col("item.size"))
        grouped = (
            level.withColumn("bucket", F.pmod(key, buckets))
            .groupBy("source", "source_size", "target", "n", "bucket")
            .agg(F.array_sort(F.collect_list(F.struct(key.alias("h"), "item"))).alias("items"))
            .select("source", "source_size", "target", buckets.alias("n"),
                    _paired(F.transform("items", lambda x: x["item"]), seed + depth).alias("state"))
        )
        grouped = stored(grouped, f"mix-level{depth}")
        finished.append(grouped.select("source", "source_size", "target", F.explode("state.done").alias("item"))
                        .select("source", "source_size", "target", "item.*"))
        level = grouped.select("source", "source_size", "target", "n", F.col("state.left").alias("item"))
        depth += 1
        if largest <= BUCKET:
            break
        largest = -(-largest // BUCKET)
    last = level.select("source", "source_size", "target", "item.*").withColumn(
        "part", F.when(F.col("part") >= 0.5, 1.0).otherwise(0.0))
    result = last
    for part in finished:
        result = result.unionByName(part)
    result = result.withColumn("copies", F.col("whole") + F.round("part").cast("long")).drop("whole", "part")
    result = _carried(stored(result.withColumn("moved", F.lit(False)), "mix-rounded"), cap, seed)
    asked_for = F.ceil(F.abs("rest") / F.pow(F.lit(2.0), F.floor(F.log2("size"))))
    result = _carried(stored(result, "mix-carried"), cap, seed, asked_for)
    copies = F.col("copies")
    even = F.floor(copies / F.col("rows")).cast("long")
    mine = even + F.when(F.col("row") < copies - even * F.col("rows"), 1).otherwise(0)
    return (
        result.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
        .select("doc_id", "source", "size", "source_size", "target", mine.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
