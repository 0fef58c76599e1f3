"""Spans against the plain patterns in Python, checksums, context, odd rows."""

from __future__ import annotations

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.pii import BASE, find_pii, masked
from millrace.llm.queries import QUERIES
from tests.llm.conftest import SF

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 13 <= len(number) <= 19 and luhn(number),
        "phone": lambda: 9 <= len(number) <= 15,
    }[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PLAIN[k], text or "") if passes(k, m.group(0))]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in find_pii(df).collect()}


def test_whole_table(text_spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_pii"](text_spark, "/root/testdata/sf0.01").collect()}
    docs = text_spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = base(d["text"])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[d["doc_id"]]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[d["doc_id"]][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.-+@ ()aé😀_b\n", max_size=60), min_size=40, max_size=40))
def test_random_texts(text_spark, texts):
    texts = texts + ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "41111111 1111-1111  5500005555555559", "+1 (017) 555-7713"]
    got = found(text_spark, texts)
    for k, t in enumerate(texts):
        assert [s for s in got[k] if s[0] in BASE] == base(t), t


def test_very_long_runs(text_spark):
    shapes = [lambda n: "1" * n, lambda n: "a" * n + "@", lambda n: "1 " * n, lambda n: "+" + "1" * n, lambda n: "a.b" * n + "@x.y", lambda n: "+1 " * n]
    short = [f(900) for f in shapes] + [None, ""]
    got = found(text_spark, short)
    for k, t in enumerate(short):
        assert [s for s in got[k] if s[0] in BASE] == base(t)
    # The plain patterns take time with the square of these.
    got = found(text_spark, [f(200_000) for f in shapes])
    assert [len([s for s in got[k] if s[0] in BASE]) for k in range(len(shapes))] == [0, 0, 0, 0, 1, 0]


def test_iban_context_and_mask(text_spark):
    text = "pay to account GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33; mail a@b.co"
    df = text_spark.createDataFrame([(1, text, "x")], "doc_id long, text string, spans string")
    row = find_pii(df).withColumn("masked", masked(F.col("text"), F.col("spans"), 0.9)).first()
    assert [(s["kind"], s["value"]) for s in row["spans"]] == [("email", "a@b.co"), ("iban", "GB82 WEST 1234 5698 7654 32")]
    assert row["spans"][1]["score"] == 1.0 and row["spans"][0]["score"] > 0.9
    assert row["masked"] == "pay to account [iban] or GB82 WEST 1234 5698 7654 33; mail [email]"


def test_empty_table(text_spark):
    assert find_pii(text_spark.createDataFrame([], "doc_id long, text string")).collect() == []
