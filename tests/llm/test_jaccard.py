"""Jaccard join: against all pairs, against SQL, odd rows, components."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import chain

import numpy as np

from millrace.llm import components as component_rounds
from millrace.llm import jaccard
from millrace.llm.components import components
from millrace.llm.jaccard import near_duplicates


def brute(rows):
    sets = []
    for _, text, _ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, r in enumerate(rows):
        least[find(k)].append(r[0])
    return sorted((r[0], len(sets[k]), min(least[find(k)])) for k, r in enumerate(rows))


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"W{k}" for k in range(40)] + ["the", "and"] * 5
    rows, texts = [], []
    for k in range(260):
        if texts and rnd.random() < 0.6:
            w = rnd.choice(texts[-30:]).split()
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            if rnd.random() < 0.3:
                w = w + rnd.choices(words, k=rnd.randint(1, 8))
        else:
            w = rnd.choices(words, k=rnd.choice([1, 3, 5, 6, 20, 60, 120]))
        texts.append(" ".join(w))
        rows.append((k * 7 % 1000, "\t ".join(w), "s"))
    return rows


def test_against_all_pairs(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    for seed in (1,):
        rows = corpus(seed)
        got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(documents(rows)).collect())
        assert got == brute(rows)


def test_odd_rows(documents):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(10, None, "s"), (11, "", "s"), (12, " \n", "s"), (13, "one two", "s"), (3, "ONE two", "s"), (14, "one two three", "s"),
            (20, passage, "s"), (20, passage, "s"), (21, passage + " end", "s"), (22, "long " * 30_000 + passage, "s")]
    docs = documents(rows)
    for name in ("node", "n", "shingle", "bytes", "root"):
        docs = docs.withColumn(name, docs.text)
    got = sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [(3, 3), (10, 10), (11, 11), (12, 12), (13, 3), (14, 14), (20, 20), (20, 20), (21, 20), (22, 20)]
    assert near_duplicates(documents([])).collect() == []
    assert near_duplicates(documents([(None, "a b c d e f", "s"), (4, "a b c d e f", "s")])).select("component_id").distinct().first()[0] == 4


def test_components(text_spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 101), (100, 101), (-5, 200)]
    got = {r["node"]: r["root"] for r in components(text_spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100, -5: -5, 200: -5}
    assert components(text_spark.createDataFrame([], "a long, b long")).collect() == []


def test_unlike_bins_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for size in (0, 1, 40, 3000):
        both = rng.integers(0, 1 << 63, size, np.uint64)
        for extra in (0, 1, 25, 700):
            x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, extra, np.uint64)])) for _ in range(2))
            bins = sum(int(m).bit_count() for m in (jaccard.marks_of(x) ^ jaccard.marks_of(y)).view(np.uint64))
            assert bins <= len(np.setxor1d(x, y))
            assert extra or bins == 0


def test_long_texts_that_miss_the_threshold_meet_once_in_the_last_product(text_spark):
    """Three sets with every kept n-gram of 200 in common but 50, not once for each of them; none too late."""
    rows = [(1000 * (k % 4 == 0) * node + k, node, 1000, k) for k in range(200) for node in (1, 2, 3)]
    rows += [(7000 + k, node, 1000, 112 + k) for k in range(80) for node in (4, 5)]
    shared = text_spark.createDataFrame(rows, "shingle long, node long, n int, place int")
    parts = text_spark.createDataFrame([(node, node) for node in range(1, 6)], "node long, root long")
    marks = [f"m{k}" for k in range(jaccard.MARKS)]
    classes = text_spark.createDataFrame([(node, *[0] * len(marks)) for node in range(1, 6)], ", ".join(f"{c} long" for c in ("node", *marks)))
    got = jaccard._meetings(shared, parts, classes, (80, 100))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (1, 3), (2, 3)]


def test_stars_take_no_round(text_spark, monkeypatch):
    written = []
    store = component_rounds.stored
    monkeypatch.setattr(component_rounds, "stored", lambda df, name: written.append(name) or store(df, name))
    links = text_spark.createDataFrame([(k, 0) for k in range(1, 20)] + [(50, 51)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(20)}, 50: 50, 51: 50}
    assert len(written) == 2


def test_sets_of_a_batch_are_made_together(monkeypatch):
    """The n-grams of each text as by itself, whatever stands beside it, with one call for all words."""
    calls, hashes = [], jaccard.word_hashes
    monkeypatch.setattr(jaccard, "word_hashes", lambda *a: calls.append(1) or hashes(*a))
    long = "x" * 63
    texts = [None, "", " \n", "one", "One\ttwo three four", "a b c d e", "a b c d e f a b c d e", "a b c d e", None, "é " * 9, long, long + "y", long + "yz", long + "zy", "abcdefgh abcdefghi abcdefghj 1 2 3", "two", ""]
    texts = [None if t is None else t.encode() for t in texts]
    values, ends = jaccard.sets_of(texts, 5)
    assert len(calls) == 1 and len(ends) == len(texts) + 1
    got = [values[low:high].tolist() for low, high in zip(ends[:-1], ends[1:], strict=True)]
    names = {}
    for text, some in zip(texts, got, strict=True):
        w = (text or b"").lower().split()
        grams = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        assert some == sorted(set(some)) and len(some) == len(grams)
        assert some == jaccard.sets_of([text], 5)[0].tolist()
        assert names.setdefault(frozenset(grams), some) == some
    assert len({tuple(some) for some in names.values()}) == len(names)
    assert len(set(chain(*names.values()))) == len(set(chain(*names)))
    nodes = jaccard.nodes_of(values, ends).tolist()
    assert len(set(nodes)) == len(names) and nodes[5] == nodes[7] and nodes[0] == nodes[1]
    marks = jaccard.marks_of(values, np.repeat(np.arange(len(texts)), np.diff(ends)), len(texts)).reshape(len(texts), -1)
    for some, own in zip(got, marks.tolist(), strict=True):
        assert own == jaccard.marks_of(np.array(some, np.uint64)).tolist()
    assert [len(x) for x in jaccard.sets_of([], 5)] == [0, 1]
