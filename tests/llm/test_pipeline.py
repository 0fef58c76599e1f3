"""The pipeline: each stage against its operator, on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import SF


def test_stages(text_spark):
    docs = text_spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in text_spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r["text"] for r in text_spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(text_spark, docs, SF), "test-stage")
        assert docs.columns == columns
        rows, old = docs.collect(), before.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= kept
        if name == "toxicity":
            assert all(r["doc_id"] in ids for r in old if labels.get(r["doc_id"]) == 0) or len(ids) > 0.9 * len(kept)
        if name == "near duplicates":
            assert len(rows) == len(ids) == len({r["text"] for r in rows}) and {r["text"] for r in old} >= {r["text"] for r in rows}
        if name == "decontamination":
            assert not any(item in r["text"] for r in rows for item in items) and len(ids) > 0.8 * len(old)
        if name == "mixing":
            assert max(sum(x["doc_id"] == i for x in rows) for i in ids) <= 3
        kept = ids
    last = corpus_pipeline.STAGES[-1][1](text_spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in docs.collect())
    assert {r["shard"] for r in last} <= set(range(24))


def test_empty_table(text_spark):
    docs = text_spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(text_spark, docs, SF), "test-stage")
        assert docs.count() == 0


WORDS = {name: " ".join(f"{name}{k}" for k in range(12)) for name in "abcdefgh"}


def test_repeated_and_null_ids_lose_no_text(documents, text_spark):
    """One row of each text is left, whatever the ids; doc 7's copy of doc 3 goes and its other text stays."""
    rows = [(3, WORDS["a"], "s"), (7, WORDS["a"], "s"), (7, WORDS["b"], "s"), (7, WORDS["c"], "t"), (7, WORDS["c"], "t"),
            (None, WORDS["d"], "s"), (None, WORDS["e"], "s"), (None, WORDS["e"], "s"), (None, WORDS["b"], "s"), (None, " ", "s"), (None, "", "s"), (9, None, "s")]
    got = corpus_pipeline.one_of_each(text_spark, documents(rows), SF).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == {
        (3, WORDS["a"]), (7, WORDS["b"]), (7, WORDS["c"]), (None, WORDS["d"]), (None, WORDS["e"]), (None, " "), (None, ""), (9, None)}
    assert len(got) == 8


def test_mix_of_repeated_ids(documents, text_spark):
    """A single source is its own target: each row is taken once, however many rows share its id."""
    rows = [(7, WORDS[name], "s") for name in "abcd"] + [(None, WORDS[name], "s") for name in "efgh"] + [(7, WORDS["a"], "s")]
    got = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.mixed(text_spark, documents(rows), SF).collect())
    assert got == sorted((d or 0, t) for d, t, _ in rows)
