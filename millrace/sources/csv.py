"""CSV drops: batch and streaming scans, and the source columns that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_FILE = "Source_File"
SOURCE_MODIFIED = "Source_Modified"
CORRUPT = "_corrupt_record"


def scan_inferred(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read drops with a header row, types inferred over all files at once."""
    return spark.read.option("header", True).option("inferSchema", True).csv(paths)


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    keep_corrupt: bool = False,
    check_header: bool = False,
) -> DataFrame:
    """Read drops with a declared schema, in one scan over all paths.

    Columns bind by position, and a malformed number becomes null.  With
    ``keep_corrupt`` the raw text of such a line is kept in ``_corrupt_record``;
    store the rows before filtering on it, since a scan that is pruned to some
    columns judges a line by those alone.
    With ``check_header`` header names that differ from the schema are an error.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.{csv,csv.gz}")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if check_header:
        reader = reader.option("enforceSchema", False)
    return reader.schema(schema).csv(paths)


def scan_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    max_files: int | None = None,
    keep_corrupt: bool = False,
    check_header: bool = False,
) -> DataFrame:
    """The streaming twin of ``scan``: each file of the directory is read once.

    Oldest files come first.  ``max_files`` bounds a micro-batch, so that a
    large backlog is taken in several commits instead of one.
    """
    reader = spark.readStream.option("header", True).option("pathGlobFilter", "*.{csv,csv.gz}")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if check_header:
        reader = reader.option("enforceSchema", False)
    return reader.schema(schema).csv(directory)


def names_stream(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """The drops of a directory as a stream of ``path``, ``modified``: names only, each once, oldest first."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.{csv,csv.gz}")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listed = reader.schema("path string, modificationTime timestamp, length long, content binary").load(directory)
    return listed.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))


def with_source(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time that file was last changed."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_MODIFIED),
    )
