"""Sharding by longest-processing-time scheduling.

Groups that must stay together (documents of equal text) go, largest first, to
the shard with the least bytes so far, kept in a heap.  The heap must not see a
list that grows with the corpus.  So only groups over ``1 / (shards * BIG)`` of
all bytes, of which there can be ``shards * BIG`` at most, are scheduled as
they are.  All smaller ones are first dealt by hash into ``shards * BUNDLES``
bundles, each a small part of one shard's share, and the bundles are scheduled.
The list has at most ``shards * (BIG + BUNDLES)`` entries at any input size.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, text_or_empty

BIG = 64
BUNDLES = 256
PER_ROW = 8
#: Rows that one task numbers.
RUN = 50_000


def row_bytes(column: str = "text") -> Column:
    return (F.octet_length(text_or_empty(column)) + PER_ROW).cast("long")


def least_loaded(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each (item, size): largest first, always to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        placed[item] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return placed


def shard(docs: DataFrame, shards: int = 24, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of each row with size, text_crc32, shard and slot.

    Size is the text's UTF-8 bytes and 8 more.  Rows of equal text share a
    shard; a null text counts as the empty one.  Slots run from 0 without gaps in
    each shard.  Sizes come out near equal unless one group alone is larger than
    a shard's share.  Repeated rows get slots of their own.  An empty table gives
    an empty table.  ``doc_id`` must be among the carried columns.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    rows = stored(
        docs.select(*carry, row_bytes().alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                    F.xxhash64(text).alias("group")),
        "shard-rows",
    )
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    limit = total / (shards * BIG)
    # Bundles are numbered from 0, large groups on from there.
    bundles = shards * BUNDLES
    large = [r["group"] for r in groups.where(F.col("bytes") > limit).select("group").sort("group").collect()]
    names = stored(spark.createDataFrame([(g, bundles + k) for k, g in enumerate(large)], "group_key long, own long"), "shard-large")
    bundle = F.pmod(F.xxhash64(F.lit(5), F.col("group")), F.lit(bundles)).cast("long")

    def with_item(df: DataFrame) -> DataFrame:
        return df.join(names, F.col("group") == F.col("group_key"), "left").withColumn(
            "item", F.coalesce("own", bundle)).drop("group_key", "own")

    items = with_item(groups).groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    placed = least_loaded([(r["item"], r["bytes"]) for r in items], shards)
    plan = stored(
        spark.createDataFrame([(r["item"], placed[r["item"]], -(-r["n"] // RUN)) for r in items],
                              "item_key long, shard int, runs long"),
        "shard-plan",
    )
    run = F.pmod(F.xxhash64(F.lit(9), F.col("doc_id")), F.col("runs"))
    dealt = with_item(rows).join(plan, F.col("item") == F.col("item_key")).drop("item_key").withColumn("run", run)
    counts = dealt.groupBy("shard", "item", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("item", "run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "item", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "item", "run").orderBy("group", "doc_id", "size")
    return (
        dealt.withColumn("within", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "item", "run"])
        .select(*carry, "size", "text_crc32", "shard", (F.col("offset") + F.col("within")).alias("slot"))
    )
