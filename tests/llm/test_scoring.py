"""Context-tree weighting against its recursive definition, and the unigram score."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import scoring
from millrace.llm.scoring import BEFORE, DEPTH, END, score_texts


class Plain:
    """One context tree per place in the decision tree, by the definition."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        self.memo = {}
        for text in texts:
            for context, place, bit in self.steps(text):
                for d in range(DEPTH + 1):
                    self.counts[place, context[DEPTH - d:]][bit] += 1
                    if d < DEPTH:
                        self.children[place, context[DEPTH - d:]].add(context[DEPTH - d - 1:])

    @staticmethod
    def steps(text):
        data = bytes([BEFORE]) * DEPTH + text.lower() + bytes([END])
        for k in range(DEPTH, len(data)):
            place = 1
            for t in range(7, -1, -1):
                bit = data[k] >> t & 1
                yield data[k - DEPTH:k], place, bit
                place = 2 * place + bit

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, place, context, extra=None):
        """Log probability of all the node saw, and of one more bit under ``extra`` (the full context, the bit)."""
        if extra is None and (place, context) in self.memo:
            return self.memo[place, context]
        counts = list(self.counts.get((place, context), (0, 0)))
        if extra:
            counts[extra[1]] += 1
        own = self.kt(*counts)
        if len(context) < DEPTH:
            below, done = 0.0, False
            for child in self.children.get((place, context), ()):
                on_path = extra and extra[0].endswith(child)
                done = done or on_path
                below += self.weighted(place, child, extra if on_path else None)
            if extra and not done:
                below += math.log(0.5)
            high = max(own, below)
            own = high + math.log(math.exp(own - high) + math.exp(below - high)) - math.log(2)
        if extra is None:
            self.memo[place, context] = own
        return own

    def log10(self, text):
        return sum(self.weighted(p, b"", (c, bit)) - self.weighted(p, b"") for c, p, bit in self.steps(text)) / math.log(10)


TEXTS = ["The cat sat on the mat", "the cat", "A dog\tand the CAT", "été à la mer", "", None, "zzz " * 40, "the cat", "unseen WORDS here", "x"]


def test_against_the_definition(documents, monkeypatch):
    monkeypatch.setattr(scoring, "CHUNK", 64)
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(3, "été à la mer", "s")]
    docs = documents(rows).withColumnRenamed("lang", "key").withColumnRenamed("source", "chunk").withColumnRenamed("n_chars", "bytes")
    held = {6, 8}
    got = score_texts(docs, F.col("doc_id").isin(*held)).collect()
    train = [(t or "").encode() for k, t, _ in rows if k not in held]
    plain = Plain(train)
    tokens = Counter(w for t in train for w in [*t.lower().split(), b"\n"])
    total = sum(tokens.values())
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        text = (TEXTS[r["doc_id"]] or "").encode()
        words = [*text.lower().split(), b"\n"]
        assert r["score"] == pytest.approx(plain.log10(text), rel=1e-9)
        assert r["base_score"] == pytest.approx(sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (len(tokens) + 1))) for w in words))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in tokens for w in words), total)
        assert r["held_out"] == (r["doc_id"] in held)


def test_empty_and_untaught(documents):
    assert score_texts(documents([]), F.lit(False)).collect() == []
    row = score_texts(documents([(1, "ab", "s")]), F.lit(True)).first()
    assert row["score"] == pytest.approx(-24 * math.log10(2)) and row["train_tokens"] == 0


@pytest.mark.parametrize("depth", [0, 2, 11])
def test_depth_is_free(documents, monkeypatch, depth):
    monkeypatch.setattr(f"{__name__}.DEPTH", depth)
    got = score_texts(documents([(k, t, "s") for k, t in enumerate(TEXTS)]), F.col("doc_id").isin(6, 8), depth).collect()
    plain = Plain([(t or "").encode() for k, t in enumerate(TEXTS) if k not in (6, 8)])
    for r in got:
        assert r["score"] == pytest.approx(plain.log10((TEXTS[r["doc_id"]] or "").encode()), rel=1e-9)


def test_contexts_reach_over_a_word(documents):
    """What follows depends on the fifth to eighth byte before it, which a passage seen in training shows."""
    seen = ["abcd----x", "efgh----y"] * 20
    rows = [(k, t, "s") for k, t in enumerate([*seen, "abcd----x", "abcd----y"])]
    got = {r["doc_id"]: r["score"] for r in score_texts(documents(rows), F.col("doc_id") >= 40).collect()}
    assert got[40] > got[41] + 1


def test_order_of_keys_is_the_stable_one():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        for high in (3, 1 << 33, (1 << 64) - 1):
            keys = rng.integers(0, high, n, np.uint64, endpoint=True)
            assert scoring.order_of(keys).tolist() == np.argsort(keys, kind="stable").tolist()


def test_strings_hold_the_bytes_before_nearest_first():
    texts = [b"abcab", b"", bytes(range(1, 250)), b"\xff" * 12]
    for depth in (1, 2, 5, 8, 9, 16, 17):
        chunk = scoring.Chunk.__new__(scoring.Chunk)
        chunk.depth = depth
        data, chunk.starts = scoring.laid(texts, depth)
        chunk.padded = np.concatenate([np.zeros(8, np.uint8), data])
        chunk.data = chunk.padded[8:]
        found = {}
        for nearest, places, words in chunk.strings():
            for at, *word in zip(places.tolist(), *[w.tolist() for w in words], strict=True):
                assert data[at - 1] == nearest
                found[at] = word
        for at, word in found.items():
            want = [*data[at - depth:at - 1][::-1].tolist(), int(data[at])]
            assert word == [int.from_bytes(bytes(want[k:k + 8])) for k in range(0, depth, 8)]
        assert len(found) == sum(len(t) + 1 for t in texts)


def test_tokens_are_hashed_once_a_pass(documents, monkeypatch):
    """Once for the lists of a chunk and once for its scores, by one task each."""
    calls, hashed = [], scoring.tokens
    monkeypatch.setattr(scoring, "tokens", lambda data: calls.append(1) or hashed(data))
    # Also frequent nearest bytes in parts.
    monkeypatch.setattr(scoring, "PIECE", 64)
    texts = [b"the cat sat on the mat", b"", b"a dog and " + b"z" * 200 + b"yz" * 90 + b"xz" * 90, b"the cat"]
    sink = scoring.pa.BufferOutputStream()
    table = scoring.pa.table({"doc_id": range(4), "bytes": scoring.pa.array(texts, scoring.pa.binary()), "held_out": [False] * 4})
    with scoring.pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    packs = scoring.pa.table({"pack": scoring.pa.array([sink.getvalue().to_pybytes()], scoring.pa.binary())})
    dealing = scoring.Dealing(DEPTH, dict(Counter(b"".join(texts))), 8)
    key = (scoring.pa.scalar(0),)
    lists = scoring.pa.Table.from_batches(scoring._lists(dealing)(key, iter(packs.to_batches())))
    assert len(calls) == 1
    ones = [(g, n, scoring.squeezed(np.full(n, scoring.UNIT if dealing.kind(g) else 1, np.uint64))) for g, n in zip(lists["group"].to_pylist(), lists["n"].to_pylist(), strict=True)]
    parts = lists["part"].to_pylist()
    assert len(set(zip(lists["group"].to_pylist(), parts, strict=True))) == len(parts) > len(set(lists["group"].to_pylist()))
    answers = scoring.pa.table({"part": parts, "group": [g for g, _, _ in ones], "n": [n for _, n, _ in ones], "taught": [0] * len(ones), "distinct": [0] * len(ones), "answers": scoring.pa.array([a for _, _, a in ones], scoring.pa.binary())})
    got = scoring._scored(dealing)(packs, answers)
    assert len(calls) == 2
    assert got["n_tokens"].to_pylist() == [7, 1, 5, 3] and got["score"].to_pylist() == [-len(t) - 1 for t in texts]
