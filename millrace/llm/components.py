"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); the root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    the smallest node around it, until every node either hangs on one other or has
    others hang on it.  The number of rounds grows with the logarithm of the
    longest chain.  Nothing but one count per round comes to the driver.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "links")
    while True:
        both = pairs.select("a", "b", F.lit(1).alias("up")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(0).alias("up")))
        around = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")), "links-around")
        if not around.where("up > 0 and n > 1").agg(F.count(F.lit(1))).first()[0]:
            return around.select(F.col("a").alias("node"), F.col("m").alias("root"))
        least = around.select("a", "m")
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            down.select("a", F.col("m").alias("b"))).distinct()
        pairs = stored(small, "links")
