"""Sharding: groups stay together, slots have no gaps, sizes are near equal."""

from __future__ import annotations

import zlib
from collections import defaultdict

from millrace.llm.queries import QUERIES
from millrace.llm.sharding import least_loaded, shard


def check(rows, texts, shards):
    """texts: doc_id and text of each row."""
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 8) for d, t in texts)
    of, slots, load = {}, defaultdict(list), [0] * shards
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    by_id = {d: t for d, t in texts}
    for r in rows:
        text = by_id[r["doc_id"]] or ""
        assert r["text_crc32"] == zlib.crc32(text.encode())
        assert of.setdefault(text, r["shard"]) == r["shard"]
    return load


def test_whole_table(text_spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in text_spark.read.parquet(f"{sf}/documents.parquet").collect()]
    load = check(QUERIES["op3_sharding"](text_spark, sf).collect(), docs, 24)
    assert max(load) <= 1.02 * sum(load) / 24


def test_hot_group_nulls_and_repeats(documents):
    rows = [(k, "copy of one long text " * 3, "s") for k in range(500)] + [(1000 + k, f"t{k} " * (k % 50), "s") for k in range(1000)]
    rows += [(5000, None, "s"), (5001, "", "s"), (None, "x", "s"), (5002, "twice", "s"), (5002, "twice", "s")]
    load = check(shard(documents(rows), 8).collect(), [(d, t) for d, t, _ in rows], 8)
    rest = sorted(load)[:-1]
    assert max(rest) <= 1.1 * sum(rest) / 7 or max(load) <= 1.1 * sum(load) / 8


def test_empty_and_clashing_columns(documents):
    assert shard(documents([])).collect() == []
    docs = documents([(1, "a", "s"), (2, "b", "s")])
    for name in ("size", "item", "group", "run", "runs", "shard", "slot", "offset", "within"):
        docs = docs.withColumn(name, docs.doc_id)
    assert len({r["shard"] for r in shard(docs, 2).collect()}) == 2


def test_least_loaded_is_longest_processing_time():
    sizes = list(enumerate([7, 7, 6, 6, 5, 5, 4, 4, 4]))
    placed = least_loaded(sizes, 3)
    load = defaultdict(int)
    for item, size in sizes:
        load[placed[item]] += size
    assert sorted(load.values()) == [15, 16, 17] or max(load.values()) <= 4 / 3 * 16
