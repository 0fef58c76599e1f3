"""A few calls on the file system Spark itself uses (HDFS, object store, local)."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; empty when nothing does."""
    hadoop_path, fs = _path(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return [status.getPath().toString() for status in found] if found else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a listed file, empty if it has none; no more than a buffer of it is read."""
    hadoop_path, fs = _path(spark, unquote(path))
    java = spark._jvm.java.io
    stream = fs.open(hadoop_path)
    if path.endswith(".gz"):
        stream = spark._jvm.java.util.zip.GZIPInputStream(stream)
    reader = java.BufferedReader(java.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear under a new name, complete or not at all."""
    hadoop_path, fs = _path(spark, path)
    if fs.exists(hadoop_path):
        raise FileExistsError(path)
    hidden, _ = _path(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(hidden)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not fs.rename(hidden, hadoop_path):
        raise FileExistsError(path)


def touch(spark: SparkSession, folder: str) -> None:
    """Let the files of a folder bear the present time, as if they had come just now."""
    now = int(time.time() * 1000)
    hadoop_path, fs = _path(spark, folder)
    for status in fs.listStatus(hadoop_path):
        if status.isFile():
            fs.setTimes(status.getPath(), now, -1)


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def exact(path: str) -> str:
    """A listed path in the form a reader takes: decoded, pattern characters escaped."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(path))


def listing(
    spark: SparkSession, places: str | Sequence[str], name_glob: str = "*.{csv,csv.gz}"
) -> DataFrame:
    """Files below the given places as rows: ``path``, ``modified``, ``length``.

    Paths are as in ``_metadata.file_path`` (URL-encoded); see ``exact``.
    Names that do not match ``name_glob`` are left out.  Only file metadata is
    read; the content column is pruned away.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
        .load(places)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("modificationTime").alias("modified"),
            "length",
        )
    )
