"""One type per column over all files: a fold of what each file's values look like.

Every value is tried as integer, long, double and date; a file's column is the
set of kinds it holds, as bits, and sets are joined by ``bit_or``.  The fold is
associative, so it runs on the map side and in any order, and the type of a
column is the least one that holds every kind found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import parse_date
from millrace.sources import files
from millrace.sources.csv import SOURCE_FILE
from millrace.sources.headers import headers_of, match, scan_layouts

INT, LONG, DOUBLE, DATE, TEXT = 1, 2, 4, 8, 16

# What a text must look like for a cast to a number to have a chance, blanks and
# control characters around it left aside.  A cast that fails builds an error
# first, which costs many times the look.
_BLANK = r"[\x00-\x20\x7F]*"
WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
NUMBER = rf"^{_BLANK}[+-]?([0-9.][0-9A-Fa-fXx.]*([EePp][+-]?[0-9]+)?[DdFf]?|[NnIi][A-Za-z]+){_BLANK}$"


def kind_of(value: Column, date_format: str) -> Column:
    """The narrowest kind a text value fits, as one bit; 0 for no value."""
    whole, number = value.rlike(WHOLE), value.rlike(NUMBER)
    return (
        F.when(value.isNull(), 0).when(whole & value.try_cast("int").isNotNull(), INT).when(whole & value.try_cast("bigint").isNotNull(), LONG)
        .when(number & value.try_cast("double").isNotNull(), DOUBLE).when(parse_date(value, date_format).isNotNull(), DATE).otherwise(TEXT)
    )


def type_of(kinds: Column) -> Column:
    """The least type that holds all kinds of a set."""
    numbers = kinds.bitwiseAND(INT | LONG | DOUBLE)
    return (
        F.when(kinds == 0, "void").when(kinds == DATE, "date").when(kinds != numbers, "string")
        .when(kinds >= DOUBLE, "double").when(kinds >= LONG, "bigint").otherwise("int")
    )


def _texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All columns of all files as text, under their header names; only names with a file's values are not null."""
    found = [row["path"] for row in files.listing(spark, paths).select("path").collect()]
    headers = {path: header for path, header in headers_of(spark, found).items()}
    for header in headers.values():
        if isinstance(header, Exception):
            raise header
    names = list(dict.fromkeys(name.strip() for header in headers.values() for name in header))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    groups: dict = {}
    for path, header in headers.items():
        if header:
            groups.setdefault(match(header, schema), []).append(path)
    if not groups:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(SOURCE_FILE, T.StringType())]))
    return scan_layouts(spark, groups, schema).select(*names, SOURCE_FILE)


def types_by_file(
    spark: SparkSession, paths: str | Sequence[str], date_format: str = "yyyy-MM-dd", by_folder: bool = False
) -> DataFrame:
    """path, column, type, common, differs: what each file's column looks like, and what all files' do.

    A file without rows does not appear.  One pass over the texts; the report
    has one row per file and column.  With ``by_folder`` the files of a folder
    count as parts of one, as Spark writes them, and ``path`` is the folder's.
    """
    rows = _texts(spark, paths)
    names = [c for c in rows.columns if c != SOURCE_FILE]
    path = F.regexp_replace(SOURCE_FILE, "/[^/]*$", "") if by_folder else F.col(SOURCE_FILE)
    kinds = rows.groupBy(path.alias("path")).agg(*[F.bit_or(kind_of(F.col(f"`{c}`"), date_format)).alias(c) for c in names])
    cells = kinds.select("path", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("kinds")) for c in names])).alias("c")).select("path", "c.*")
    common = cells.groupBy("column").agg(type_of(F.bit_or("kinds")).alias("common"))
    return cells.join(common, "column").select(
        "path", "column", type_of(F.col("kinds")).alias("type"), "common",
        (type_of(F.col("kinds")) != F.col("common")).alias("differs"))


def scan_common(spark: SparkSession, paths: str | Sequence[str], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The rows of all files with the common type of each column; a column without values is text."""
    common = {r["column"]: r["common"] for r in types_by_file(spark, paths, date_format).select("column", "common").distinct().collect()}

    def typed(name: str) -> Column:
        value, kind = F.col(f"`{name}`"), common.get(name, "void")
        if kind in ("void", "string"):
            return value
        return (parse_date(value, date_format) if kind == "date" else value.cast(kind)).alias(name)

    rows = _texts(spark, paths)
    return rows.select(*[typed(c) for c in rows.columns if c != SOURCE_FILE])
