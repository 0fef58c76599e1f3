"""Decontamination: planted items with edits are found, clean texts are left, against a plain search."""

from __future__ import annotations

import random

import numpy as np

from millrace.llm.decontaminate import Finder, Index, allowed, edits, walk_hashes, with_hits

RND = random.Random(8)
VOCABULARY = [f"v{k}" for k in range(400)] + ["the", "of", "and"] * 40


def text(n, rnd=RND):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


ITEMS = [(k, text(n)) for k, n in enumerate([3, 8, 15, 15, 22, 40, 57])] + [(50, ""), (51, None), (2, "a b c d")]


def plain(doc):
    words = {w: k for k, w in enumerate(sorted({w for _, t in ITEMS for w in (t or "").split()} | set(doc.split())))}
    symbols = np.array([words[w] for w in doc.split()], np.int64)
    out = set()
    for item_id, t in ITEMS:
        item = np.array([words[w] for w in (t or "").split()], np.int64)
        if len(item) and any(edits(item, symbols[s:s + len(item) + allowed(len(item))]) <= allowed(len(item)) for s in range(len(symbols))):
            out.add(item_id)
    return out


def test_edits():
    a = np.array
    assert edits(a([1, 2, 3]), a([1, 2, 3, 9])) == 0
    assert edits(a([1, 2, 3]), a([1, 3])) == 1
    assert edits(a([1, 2, 3]), a([7, 8, 9, 9])) == 3
    assert edits(a([1, 2, 3, 4]), a([1, 5, 2, 3, 4])) == 1


def test_recall_against_plain_search():
    index = Index.of([(k, t.encode() if t is not None else None) for k, t in ITEMS])
    docs, want = [], []
    for k in range(150):
        words = text(60).split()
        item = RND.choice(ITEMS[:7])[1].split()
        for _ in range(RND.randint(0, allowed(len(item)))):
            at = RND.randrange(len(item))
            item[at:at + 1] = RND.choice([[], ["NEW"], [item[at], "new,"]]) or item[at + 1:at + 1]
        words[20:20] = item
        docs.append(" ".join(words).upper() if k % 2 else " ".join(words))
        want.append(plain(docs[-1].lower().replace(",", "")))
    got = [set(x[::3]) for x in Finder(index).hits([d.encode() for d in docs])]
    assert all(g <= w for g, w in zip(got, want, strict=True))
    assert sum(len(g) for g in got) >= 0.95 * sum(len(w) for w in want)


def test_odd_rows(documents, text_spark):
    bench = text_spark.createDataFrame([*ITEMS, (None, "x y z")], "item_id long, text string")
    item = ITEMS[4][1]
    rows = [(1, item, "s"), (2, "clean " * 20_000 + item.title(), "s"), (3, None, "s"), (4, "", "s"), (None, item, "s"), (5, "clean words", "s"), (1, item, "s")]
    got = with_hits(documents(rows).withColumnRenamed("lang", "_hits"), bench).collect()
    found = sorted(((r["doc_id"] or 99, [h["item_id"] for h in r["hits"]], [h["start"] for h in r["hits"]]) for r in got))
    assert found == [(1, [4], [0]), (1, [4], [0]), (2, [4], [20_000]), (3, [], []), (4, [], []), (5, [], []), (99, [4], [0])]
    assert with_hits(documents([]), bench).collect() == []
    assert with_hits(documents(rows[:2]), bench.limit(0)).select("hits").first()["hits"] == []


def test_long_items_among_short_ones():
    """Every length has the target recall, not only the lengths that most items have."""
    rnd = random.Random(4)
    items = [(k, text(rnd.randint(8, 20), rnd)) for k in range(300)] + [(1000 + k, text(n, rnd)) for k, n in enumerate([150, 200, 300, 400])]
    index = Index.of([(k, t.encode()) for k, t in items])
    docs, want = [], []
    for item_id, t in items[300:] * 6:
        words = t.split()
        for at in rnd.sample(range(1, len(words)), allowed(len(words))):
            words[at] = "NEW"
        docs.append(" ".join(["clean"] * 30 + words + ["clean"] * 30).encode())
        want.append(item_id)
    got = [set(x[::3]) for x in Finder(index).hits(docs)]
    assert sum(w in g for g, w in zip(got, want, strict=True)) >= 0.95 * len(want)


def test_items_without_an_id_are_found(documents, text_spark):
    bench = text_spark.createDataFrame([(None, ITEMS[3][1]), (None, ITEMS[5][1]), (7, ITEMS[4][1])], "item_id long, text string")
    rows = [(1, "so " + ITEMS[3][1], "s"), (2, ITEMS[4][1] + " " + ITEMS[5][1], "s"), (3, "clean words only", "s")]
    got = with_hits(documents(rows), bench).collect()
    assert {r["doc_id"]: [(h["item_id"], h["distance"]) for h in r["hits"]] for r in got} == {1: [(None, 0)], 2: [(7, 0), (None, 0)], 3: []}


def test_hashes_do_not_depend_on_the_number_of_walks():
    symbols, lengths = np.arange(40).reshape(2, 20), np.array([20, 13])
    assert (walk_hashes(symbols, lengths, 8) == walk_hashes(symbols, lengths, 64)[:, :8]).all()
