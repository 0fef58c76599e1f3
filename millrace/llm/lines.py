"""Line dedup by winnowing over line hashes.

Every shortest stretch of lines with ``WORDS`` words or more is a window, and
the line with the least hash in it is a fingerprint.  Windows depend on content
alone, so a repeated run of ``2 * WORDS`` words or more holds a whole window,
and both copies have its fingerprint.

A fingerprint is joined with the places of its like, and the match is extended
line by line in both directions as far as a place before it goes on alike: for
each length the run of lines has a hash, and the first place of each hash is
one grouped minimum, so no pairs within a group are made.  Extension stops
after ``WORDS`` words, where the next fingerprint takes over.  What matches
forwards and what matches backwards count together only if they have the same
first place, so a deleted run of ``WORDS`` words or more always stands whole at
an earlier place (by document, then line); its first copy stays.  A repeated
run of ``2 * WORDS`` words has one side of ``WORDS`` alone, so it is found.

Whole lines are compared: a passage that begins or ends inside a line, or that
is wrapped differently in its copy, counts only as far as whole lines agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import mixed, spare_names, stored

WORDS = 25
_SCHEMA = "doc_id long, version long, at int, way int, reach int, low int, high int, words int, own int, run long"


def fingerprints(words: np.ndarray, hashes: np.ndarray, least: int) -> np.ndarray:
    """Places of the fingerprints among lines with these word counts and hashes."""
    total = np.concatenate([[0], np.cumsum(words)])
    picked, end = set(), 0
    for start in range(len(words)):
        end = max(end, start + 1)
        while end <= len(words) and total[end] - total[start] < least:
            end += 1
        if end > len(words):
            break
        # The shortest stretch from here is a window only if no later start has the same end.
        if total[end] - total[start + 1] < least or start + 1 == end:
            picked.add(start + int((hashes[start:end][::-1]).argmin() * -1 + (end - start) - 1))
    return np.array(sorted(picked), np.int64)


def _runs(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "version", "at", "way", "reach", "low", "high", "words", "own", "run"]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 7, pa.int64()]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            out: list[tuple] = []
            for doc, version, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = [(k, line.split()) for k, line in enumerate((text or b"").split(b"\n"))]
                lines = [(k, w) for k, w in lines if w]
                if not lines:
                    continue
                places = [k for k, _ in lines]
                counts = np.array([len(w) for _, w in lines])
                named = [xxhash.xxh3_64_intdigest(b" ".join(w)) for _, w in lines]
                for p in fingerprints(counts, mixed(np.array(named, np.uint64)), least).tolist():
                    for way, step in ((0, 1), (1, -1)):
                        run_hash, total, k, reach = way, 0, p, 0
                        while 0 <= k < len(lines):
                            run_hash = xxhash.xxh3_64_intdigest(named[k].to_bytes(8, "little"), run_hash)
                            total += int(counts[k])
                            low, high = (places[p], places[k]) if way == 0 else (places[k], places[p])
                            out.append((doc, version, places[p], way, reach, low, high, total, int(counts[p]), run_hash - (1 << 63)))
                            if total - counts[p] >= least:
                                break
                            k, reach = k + step, reach + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], schema=schema)

    return run


def repeated_lines(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """doc_id, version (hash of the text) and ranges, array<struct<low,high>> of line numbers to delete.

    Only documents with such lines.  Rows of one doc_id and text are one document.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("bytes"))
    rows = stored(keyed.mapInArrow(_runs(least), _SCHEMA).dropDuplicates(["doc_id", "version", "at", "way", "reach"]), "line-runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "at")
    # A run read forwards and one read backwards have different hashes, as their seeds differ.
    first = rows.groupBy("run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = rows.join(first, "run").where(F.col("first") < place)
    # Both ways from one fingerprint, as far as they go on alike at one and the same earlier place.
    forth, back = (F.max(F.when(F.col("way") == way, F.struct("words", "low", "high"))) for way in (0, 1))
    per = again.groupBy("doc_id", "version", "at", "first").agg(F.min("own").alias("own"), forth.alias("forth"), back.alias("back"))
    words = F.coalesce("forth.words", "own") + F.coalesce("back.words", "own") - F.col("own")
    whole = per.where(words >= least).select(
        "doc_id", "version", F.coalesce("back.low", "at").alias("low"), F.coalesce("forth.high", "at").alias("high"))
    return whole.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("ranges"))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
    def cut(text, low, high):
        if low is None or text is None:
            return text
        gone = set()
        for a, b in zip(low, high, strict=True):
            gone.update(range(a, b + 1))
        return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)

    return pd.Series([cut(*x) for x in zip(texts, lows, highs, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """The rows with ``ranges`` and ``kept``, the text without its repeated runs of lines.

    Lines are compared word by word; blank ones neither count nor break a run, but
    go with a run that spans them.  A null text stays null and an empty one empty,
    both without ranges.  Null ids come last in the order.  A run repeated within
    one text loses its later copies too.  Other columns stay as they are.
    """
    spare = docs.drop("ranges", "kept")
    d, v = spare_names(spare, 2)
    found = repeated_lines(docs, least).select(F.col("doc_id").alias(d), F.col("version").alias(v), "ranges")
    joined = spare.join(found, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(v)), "left").drop(d, v)
    shape = "array<struct<low:int,high:int>>"
    part = lambda name: F.transform("ranges", lambda r: r[name])
    return joined.withColumn("kept", _without("text", part("low"), part("high"))).withColumn(
        "ranges", F.coalesce("ranges", F.array().cast(shape)))
