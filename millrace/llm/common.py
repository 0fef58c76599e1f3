"""Helpers the text operators share: stored intermediate frames, words and their hashes."""

from __future__ import annotations

import atexit

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path, tune
from millrace.sources import files

WORD = r"[^\x20\x09-\x0D]+"

# Python workers get texts in batches of at most so many rows and bytes, so
# that a batch of very long texts does not outgrow a worker.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

#: Longer words are hashed one by one.
LONG_WORD = 64
#: The lowest bytes of a number, by how many.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_stored: list[tuple[SparkSession, str]] = []


def tune_text(spark: SparkSession) -> SparkSession:
    """The engine's settings and those for text batches."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return tune(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back.

    Lineage is cut there: executors lost later cost no more than the rereading
    of a few files.  The copy lives as long as the Python process, as results
    are lazy and may read it at any time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _stored.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def forget() -> None:
    """Remove all stored copies."""
    while _stored:
        spark, path = _stored.pop()
        try:
            files.delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended, and its scratch folder is the cluster's to clear
            return


atexit.register(forget)


def spare_names(df: DataFrame, many: int) -> list[str]:
    """Column names that the frame does not have, whatever their case."""
    taken, names, k = {c.lower() for c in df.columns}, [], 0
    while len(names) < many:
        if f"_spare{k}" not in taken:
            names.append(f"_spare{k}")
        k += 1
    return names


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of a value written as text, by its remainder; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


class WordHashes(dict):
    """64-bit hashes of words, each computed once; forgets all when it grows too large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split() if text else []


def in_words(data: np.ndarray) -> np.ndarray:
    """Which bytes are no ASCII white space."""
    return (data != 0x20) & (data - np.uint8(9) > 4)


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of each word between ASCII white space."""
    edge, inside = np.zeros(len(data) + 1, bool), in_words(data)
    edge[:-1] = inside
    edge[1:] ^= inside
    places = np.flatnonzero(edge)
    return places[::2], places[1::2] - places[::2]


def word_hashes(padded: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of words by their first bytes and lengths, eight bytes a step; eight more bytes follow the last word."""
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    hashes = mixed((eight[first] & _LOW[np.minimum(length, 8)]) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero((length > 8) & (length <= LONG_WORD))
    for done in range(8, LONG_WORD, 8):
        if not len(long):
            break
        left = length[long] - done
        hashes[long] = mixed(hashes[long] ^ (eight[first[long] + done] & _LOW[np.minimum(left, 8)]))
        long = long[left > 8]
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(padded[first[k] : first[k] + length[k]])
    return hashes


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit values (the finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one run."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    run = min(size, len(hashes))
    total = len(hashes) - run + 1
    value = np.full(total, run, np.uint64)
    for k in range(run):
        value *= np.uint64(0x9E3779B97F4A7C15)
        value += hashes[k : k + total]
    return mixed(value)
