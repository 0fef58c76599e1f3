"""Header rows of drops: read once a file, and matched with a schema by name."""

from __future__ import annotations

import csv as lines
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import files
from millrace.sources.csv import CORRUPT, SOURCE_FILE, SOURCE_MODIFIED, with_source

#: Headers that are read at the same time.
THREADS = 16


@dataclass(frozen=True)
class Layout:
    """The columns of a file in its own order: a name of the schema, or None for one it does not have."""

    columns: tuple[str | None, ...]
    note: str | None = None


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str] | Exception]:
    """The header names of each file, [] for an empty one, or what went wrong.

    No more than the first line of each file is read.
    """

    def read(path: str) -> list[str] | Exception:
        try:
            line = files.first_line(spark, path)
        except Exception as error:  # noqa: BLE001  one file's trouble is not the others'
            return error
        return next(lines.reader([line.lstrip("﻿")]), []) if line else []

    with ThreadPoolExecutor(THREADS) as pool:
        return dict(zip(paths, pool.map(read, paths), strict=True))


def match(header: Sequence[str], schema: T.StructType, required: Sequence[str] = ()) -> Layout:
    """Where each column of a header belongs; ValueError if the file must not be taken.

    Names are compared without case and surrounding blanks.  Columns may come
    in any order, be missing (they will be null) or unknown (they are left
    out).  Refused are headers that lack a required column, name one twice or
    have none of the schema's.
    """
    known = {name.lower(): name for name in schema.names}
    columns = [known.get(name.strip().lower()) for name in header]
    given = [c for c in columns if c is not None]
    if not given:
        raise ValueError("no known column")
    twice = sorted({c for c in given if given.count(c) > 1})
    if twice:
        raise ValueError(f"columns twice: {', '.join(twice)}")
    lacking = [c for c in required if c not in given]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    absent = [c for c in schema.names if c not in given]
    unknown = [name.strip() for name, c in zip(header, columns, strict=True) if c is None]
    notes = [f"{what}: {', '.join(names)}" for what, names in (("missing", absent), ("unknown", unknown)) if names]
    return Layout(tuple(columns), "; ".join(notes) or None)


def by_position(schema: T.StructType) -> Layout:
    return Layout(tuple(schema.names))


def scan_layouts(spark: SparkSession, groups: Mapping[Layout, Iterable[str]], schema: T.StructType) -> DataFrame:
    """Files of several layouts as one frame of the schema, with the corrupt line and the source columns.

    One scan per layout, however many files share it.
    """
    frames = []
    for layout, paths in groups.items():
        own = [T.StructField(f"_unknown_{k}", T.StringType()) if name is None else schema[name] for k, name in enumerate(layout.columns)]
        own.append(T.StructField(CORRUPT, T.StringType()))
        reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", CORRUPT).schema(T.StructType(own))
        rows = with_source(reader.csv([files.exact(path) for path in paths]))
        frames.append(rows.select(
            *[F.col(f.name) if f.name in layout.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
            CORRUPT, SOURCE_FILE, SOURCE_MODIFIED))
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    return every


def scan_by_name(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Rows of all drops below the paths, columns bound by header name; a header that does not match raises."""
    found = [row["path"] for row in files.listing(spark, paths).select("path").collect()]
    groups: dict[Layout, list[str]] = {}
    for path, header in headers_of(spark, found).items():
        if isinstance(header, Exception):
            raise header
        if header:
            groups.setdefault(match(header, schema, required), []).append(path)
    if not groups:
        return spark.createDataFrame([], schema)
    return scan_layouts(spark, groups, schema).select(*schema.names)
