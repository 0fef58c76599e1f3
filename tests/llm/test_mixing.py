"""Mixing: targets against iterated resharing, sums, caps and odd rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from millrace.llm.mixing import mix
from millrace.llm.queries import QUERIES
from tests.llm.conftest import SF


def targets(sizes: dict, weights=(1, 2, 3), cap=3):
    """Share by weight, stop at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(w for s, w in weight.items() if s not in full)
        now = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in order}
        over = {s for s in order if s not in full and now[s] > cap * sizes[s]}
        if not over:
            return now
        full |= over


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken, largest = targets(sizes), defaultdict(int), defaultdict(int)
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(1, largest[source] / 2 + 1)


def test_whole_table(text_spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in text_spark.read.parquet(f"{SF}/documents.parquet").collect()]
    first = QUERIES["op1_mixing"](text_spark, SF).collect()
    check(first, docs)
    again = QUERIES["op1_mixing"](text_spark, SF).collect()
    key = lambda r: tuple(r)
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_capped_null_repeated_and_empty(documents):
    rows = [(k, "w " * (k % 7 + 1), "a") for k in range(400)]
    rows += [(1000 + k, "x y", "b") for k in range(3)] + [(7, "one two", None)] * 50 + [(None, "n", "c"), (None, None, "c"), (8, "", "d")]
    check(mix(documents(rows)).collect(), rows)


def test_empty_table_and_clashing_columns(documents):
    assert mix(documents([])).collect() == []
    docs = documents([(1, "a b c", "s")])
    for name in ("size", "target", "item", "bucket", "part", "n"):
        docs = docs.withColumn(name, docs.doc_id)
    assert [r["taken"] for r in mix(docs).collect()] == [3]


def test_expected_copies_are_what_is_due(documents):
    docs = documents([(k, "w " * 5, "a") for k in range(60)] + [(100 + k, "w " * 5, "b") for k in range(60)])
    runs, total = 3, Counter()
    for seed in range(runs):
        for r in mix(docs, weights=(1, 2), seed=seed * 100).collect():
            total[r["doc_id"] < 100] += r["copies"]
    assert total[True] / runs == pytest.approx(40, abs=1.0)
    assert total[False] / runs == pytest.approx(80, abs=1.0)


def test_every_source_is_near_its_target(text_spark):
    """Within two per cent, or half of the source's shortest text, whatever the texts' lengths."""
    got = QUERIES["op1_mixing"](text_spark, SF.replace("0.001", "0.01")).collect()
    taken, shortest = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        shortest[r["source"]] = min(shortest.get(r["source"], 1 << 30), r["size"] or 1 << 30)
    for r in got:
        assert abs(taken[r["source"]] - r["target"]) <= max(0.02 * r["target"], shortest[r["source"]]), r["source"]


def test_a_long_text_left_at_the_root_is_made_up_for(documents):
    rows = [(k, "w " * (3000 if k < 3 else 40 if k < 30 else 3), "a") for k in range(200)] + [(1000 + k, "w " * 30, "b") for k in range(400)]
    got = mix(documents(rows)).collect()
    check(got, rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 30 for s, t in target.items())
