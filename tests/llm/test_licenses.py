from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from millrace.llm import licenses
from millrace.llm.common import read
from millrace.llm.queries import QUERIES
from tests.llm.conftest import SF


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_phrases(text):
    """(place, label) of the phrases by looking at every place."""
    words = plain_words(text)
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    return [(i, label) for i in range(len(words)) for phrase, label in phrases.items() if tuple(words[i : i + len(phrase)]) == phrase]


def test_statistics_equal_plain_search():
    draw = random.Random(2)
    for _ in range(60):
        sequences = [draw.choices(range(4), k=draw.randrange(1, 25)) for _ in range(3)]
        automaton, text = licenses.Automaton(sequences), draw.choices(range(5), k=40)
        lengths, states = automaton.statistics(text)
        for i, (length, state) in enumerate(zip(lengths, states, strict=True)):
            def places(size):
                run = text[i + 1 - size : i + 1]
                return {(s, e) for s, q in enumerate(sequences) for e in range(size - 1, len(q)) if q[e + 1 - size : e + 1] == run}

            assert length == max([0, *(m for m in range(1, i + 2) if places(m))])
            if length:
                assert set(automaton.places[state]) == places(length) and len(automaton.places[state]) == len(places(length))


def test_stretches_lose_nothing():
    """The same spans as when the whole text goes through the automaton."""
    draw = random.Random(6)
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    pool = " ".join(text for _, text in (*licenses.PHRASES, *licenses.TEMPLATES)).split()
    for _ in range(40):
        parts = []
        for _ in range(draw.randrange(1, 12)):
            start = draw.randrange(len(pool))
            parts += pool[start : start + draw.randrange(1, 40)] + draw.choices(["foo", "bar", "License", "MIT"], k=draw.randrange(0, 4))
        text = " ".join(parts).encode()
        expected = scanner.scan(text)
        whole = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
        whole.stretches = lambda numbers: [(0, len(numbers))]
        # An unknown word has no transition, so the whole text can be streamed at once.
        assert whole.scan(text) == expected
        assert [(s["first"], s["label"]) for s in expected[1] if s["phrase"]] and sorted(
            (s["first"], s["label"]) for s in expected[1] if s["phrase"]) == sorted(plain_phrases(text.decode())) or not plain_phrases(text.decode())


def labels_of(text):
    return {s["label"] for s in licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES).scan(text.encode())[1]}


def test_copies_and_edited_copies_of_templates_are_found():
    draw = random.Random(8)
    for label, text in licenses.TEMPLATES:
        words = text.split()
        assert label in labels_of("some words before " + text.upper() + " and after")
        if len(words) > 25:
            for k in range(10, len(words), 12):
                words[k] = "changed"
            assert label in labels_of("\n * ".join(words))
    prose = " ".join(draw.choices("the of and to use this software is in any for with copy".split(), k=3000))
    assert labels_of(prose) == set()


def test_chains_keep_the_order_of_the_template():
    assert licenses.chains([(0, 4, 4, 5), (6, 10, 10, 5)]) == [(0, 10, 10)]
    assert licenses.chains([(0, 4, 10, 5), (6, 10, 4, 5)]) == [(0, 4, 5), (6, 10, 5)]
    assert licenses.chains([(0, 4, 4, 5), (3, 9, 9, 7)]) == [(0, 9, 10)]
    assert licenses.chains([]) == []


def test_whole_table_against_plain_search(text_spark):
    got = {row["doc_id"]: row for row in QUERIES["op13_licenses"](text_spark, SF).collect()}
    docs = read(text_spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(row["n_base"] for row in got.values())
    for doc in docs:
        row, found = got[doc["doc_id"]], plain_phrases(doc["text"])
        places = [i for i, _ in found]
        base = ",".join(sorted({label for _, label in found}))
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(plain_words(doc["text"])), len(found), base)
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert set(base.split(",")) - {""} <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_nulls_empty_long_and_clashing_columns(text_spark):
    long = "word " * 200_000 + "MIT-License, the GNU General\nPublic  license"
    rows = [(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, long, None), (3, "Straße MIT Licence apache license", "c")]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string, licenses string").withColumn("spans", F.lit(1))
    got = licenses.with_licenses(docs).select("doc_id", "licenses.n_words", F.transform("licenses.spans", lambda s: s["label"]).alias("l")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 0, []), (1, 0, []), (None, 0, []), (2, 200_007, ["mit", "gpl"]), (3, 5, ["apache"])], key=repr)
    assert licenses.with_licenses(docs.limit(0)).count() == 0
