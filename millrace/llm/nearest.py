"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a sample of at most ``SAMPLE`` vectors; all vectors are
dealt to its leaves.  A query opens branches through a priority queue, nearest
centre first, until it has met ``visits`` leaves and these hold enough vectors.  How many that are is
calibrated: leaf visits widen until the recall of sampled queries, against
brute force over the sample, reaches ``RECALL``.

Of equal vectors only the ``k + 1`` smallest ids can be among ``k`` nearest, so
the others are left out before vectors move, and equal queries are searched
once.  A leaf with many vectors is split into blocks of about ``BLOCK``, to
each of which its queries are sent.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

SAMPLE, CALIBRATED, RECALL = 20_000, 200, 0.97
BRANCHES, LEAF, MOST_LEAVES = 8, 1000, 1024
BLOCK = 4000


class Tree:
    """Nodes are (centres of children, children); a leaf is its number."""

    def __init__(self, points: np.ndarray, leaves: int, seed: int = 1) -> None:
        self.leaves = 0
        rng = np.random.default_rng(seed)
        most = max(1, len(points) // max(1, leaves))
        self.root = self._grown(points, most, rng)

    def _grown(self, points: np.ndarray, most: int, rng: np.random.Generator):
        if len(points) <= max(most, BRANCHES):
            return self._leaf()
        centres = points[rng.choice(len(points), BRANCHES, replace=False)]
        for _ in range(12):
            near = self._near(points, centres)
            centres = np.stack([points[near == c].mean(0) if (near == c).any() else points[rng.integers(len(points))] for c in range(len(centres))])
        near = self._near(points, centres)
        sizes = np.bincount(near, minlength=len(centres))
        if sizes.max() == len(points):
            return self._leaf()
        used = np.flatnonzero(sizes)
        return centres[used], [self._grown(points[near == c], most, rng) for c in used]

    def _leaf(self) -> int:
        self.leaves += 1
        return self.leaves - 1

    @staticmethod
    def _near(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)

        def down(node, rows: np.ndarray) -> None:
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                near = self._near(points[rows], node[0])
                for c, child in enumerate(node[1]):
                    down(child, rows[near == c])

        down(self.root, np.arange(len(points)))
        return out

    def order(self, point: np.ndarray, visits: int, counts: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first leaves met, best bin first: ``visits`` of them, and more until they hold ``enough`` vectors."""
        heap, met, ties, held = [(0.0, 0, self.root)], [], 0, 0
        while heap and (len(met) < visits or held < enough):
            _, _, node = heapq.heappop(heap)
            if isinstance(node, int):
                met.append(node)
                held += int(counts[node]) if counts is not None else enough
                continue
            for d, child in zip(((node[0] - point) ** 2).sum(1), node[1], strict=True):
                ties += 1
                heapq.heappush(heap, (float(d), ties, child))
        return met


def calibrated(tree: Tree, points: np.ndarray, k: int, seed: int = 2) -> int:
    """Leaf visits at which sampled queries reach the recall asked for."""
    if len(points) <= k or tree.leaves == 1:
        return tree.leaves
    leaf, rng, needed = tree.leaf_of(points), np.random.default_rng(seed), []
    for q in rng.choice(len(points), min(CALIBRATED, len(points)), replace=False):
        d = ((points - points[q]) ** 2).sum(1)
        d[q] = np.inf
        rank = {n: r for r, n in enumerate(tree.order(points[q], tree.leaves))}
        needed += [rank[int(leaf[x])] + 1 for x in np.argpartition(d, k)[:k]]
    return int(np.quantile(needed, RECALL, method="higher"))


def _clean(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part: not null, not zero, all components finite numbers."""
    v = F.col(vector)
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.where(F.col(key).isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), F.transform(v, lambda x: x.cast("double")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _nearest(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest in one block to each query sent there."""
    rows = []
    if len(left) and len(right):
        points, ids = np.stack(right["v"].to_numpy()), right["id"].to_numpy()
        for q, v in zip(left["q"], left["v"], strict=True):
            score = np.sqrt(((points - v) ** 2).sum(1))
            near = np.flatnonzero(score <= np.partition(score, min(k, len(score)) - 1)[min(k, len(score)) - 1])
            near = near[np.lexsort((ids[near], score[near]))][:k]
            rows += [(q, ids[x], score[x]) for x in near]
    return pd.DataFrame(rows, columns=["q", "vec_id", "score"]).astype({"q": "int64", "vec_id": "int64", "score": "float64"})


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by Euclidean distance among those found.

    Queries are rows of the same form as the vectors; a vector with a query's own
    id is no neighbour of it.  Ties go to the smaller id.  Rows that are null or
    zero, hold a null or a number that is not finite, or have another length than
    most, take no part.  Repeated rows of one id and vector count once.  An empty
    table on either side gives an empty result.
    """
    spark = vectors.sparkSession
    every = _clean(vectors, key, vector)
    width = every.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], schema)
    width = width["w"]
    smallest = Window.partitionBy("v").orderBy("id")
    base = stored(every.where(F.size("v") == width).distinct().withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).drop("r"), "ann-base")
    total = base.count()
    picked = base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    points = np.array([r["v"] for r in picked], np.float64).reshape(-1, width)
    tree = Tree(points, min(MOST_LEAVES, -(-total // LEAF)))
    visits = calibrated(tree, points, k)
    held = spark.sparkContext.broadcast(tree)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("leaf", pa.array(held.value.leaf_of(_matrix(batch.column(1), width))))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [held.value.order(p, visits, counts, k + 1) for p in _matrix(batch.column(1), width)]
            yield batch.append_column("leaves", pa.array(lists, pa.list_(pa.int64())))

    base = stored(base.mapInArrow(dealt, "id long, v array<double>, leaf long"), "ann-leaves")
    sizes = stored(base.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")), "ann-sizes")
    blocks = sizes.select("leaf", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    # One number a leaf, so that no query ends with fewer than it could find.
    counts = np.zeros(tree.leaves, np.int64)
    for row in sizes.collect():
        counts[row["leaf"]] = row["n"]
    cells = base.join(blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).select("leaf", "block", "id", "v")
    asked = _clean(queries, key, vector).where(F.size("v") == width).distinct()
    classes = stored(asked.withColumn("rep", F.min("id").over(Window.partitionBy("v"))), "ann-queries")
    reps = classes.where("id = rep").select("rep", "v").mapInArrow(sent, "rep long, v array<double>, leaves array<long>")
    spread = reps.withColumn("leaf", F.explode("leaves")).join(blocks, "leaf").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("leaf", "block", F.col("rep").alias("q"), "v")
    found = spread.groupBy("leaf", "block").cogroup(cells.groupBy("leaf", "block")).applyInPandas(
        lambda a, b: _nearest(a, b, k + 1), "q long, vec_id long, score double")
    nearest = Window.partitionBy("q").orderBy("score", "vec_id")
    found = found.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1).drop("r")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        classes.select(F.col("id").alias("query_id"), "rep").join(found, F.col("rep") == F.col("q"))
        .where("vec_id != query_id").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
