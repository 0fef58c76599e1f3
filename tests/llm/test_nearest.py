"""Nearest neighbours: recall against brute force, exact scores, odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import nearest
from millrace.llm.nearest import search
from millrace.llm.queries import QUERIES


def test_recall_on_the_whole_table(text_spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 40)
    sf = "/root/testdata/sf0.01"
    rows = text_spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows}
    got = QUERIES["op9_nearest"](text_spark, sf).collect()
    hits = total = 0
    for q in (v for v in vectors if v % 100 == 0):
        scores = sorted((float(np.sqrt(((vectors[q] - x) ** 2).sum())), i) for i, x in vectors.items() if i != q)[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in mine] == list(range(1, 11)) and [(r[2], r[1]) for r in mine] == sorted((r[2], r[1]) for r in mine)
        for _, i, score in mine:
            assert score == pytest.approx(float(np.sqrt(((vectors[q] - vectors[i]) ** 2).sum())), rel=1e-12)
        hits, total = hits + len({i for _, i in scores} & {r[1] for r in mine}), total + 10
    assert hits / total >= 0.9


def test_odd_rows(text_spark):
    schema = "vec_id long, embedding array<float>, leaf string"
    rows = [(k, [1.0, 2.0], "x") for k in range(40)] + [(100, [1.0, 3.0], "x"), (101, None, "x"), (102, [0.0, 0.0], "x"), (103, [1.0, None], "x"),
            (104, [float("nan"), 1.0], "x"), (105, [1.0, float("inf")], "x"), (106, [1.0], "x"), (None, [1.0, 2.0], "x"), (0, [1.0, 2.0], "x")]
    df = text_spark.createDataFrame(rows, schema)
    got = search(df, df.where("vec_id in (0, 20, 100, 102)"), k=3).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0),
        (100, 1, 0, 1.0), (100, 2, 1, 1.0), (100, 3, 2, 1.0)]
    assert search(df.limit(0), df).collect() == [] and search(df, df.limit(0)).collect() == []
    assert [r["vec_id"] for r in search(df.where("vec_id in (1, 2)"), df.where("vec_id = 1")).collect()] == [2]


def test_leaves_of_one_vector_still_give_enough(text_spark, monkeypatch):
    """Skewed vectors in leaves of one or two: every query finds as many as are asked for."""
    monkeypatch.setattr(nearest, "LEAF", 1)
    draw = np.random.default_rng(7)
    points = np.concatenate([draw.normal(0, 0.01, (150, 3)), draw.normal(5, 3, (50, 3)), [[90.0, 90.0, 90.0]]])
    df = text_spark.createDataFrame([(k, [float(x) for x in p]) for k, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = search(df, df.where("vec_id % 20 = 0")).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(found) == set(range(0, 201, 20)) and all(len(set(ids)) == 10 for ids in found.values())


def test_visits_go_on_until_leaves_hold_enough():
    points = np.arange(12, dtype=float)[:, None]
    tree = nearest.Tree(points, 12)
    counts = np.bincount(tree.leaf_of(points), minlength=tree.leaves)
    met = tree.order(points[0], 1, counts, 5)
    assert counts[met].sum() >= 5 and len(tree.order(points[0], 1)) == 1
