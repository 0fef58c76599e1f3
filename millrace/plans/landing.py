"""Drops into a landing table: each file once, one bad file never in the way of the others.

What became of a file stands in the manifest beside the table (``manifest_of``):
landed, skipped for too few rows, or put in quarantine with the reason.  Batch
runs and streams share it, so neither reads a file the other has taken.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import date_of
from millrace.operators.incremental import min_rows_guard, stamp_batch
from millrace.plans import lms
from millrace.session import staged
from millrace.sources import csv, files, headers
from millrace.sources.manifest import CLAIMED, LANDED, QUARANTINED, SKIPPED, Manifest, Outcome
from millrace.sources.tables import Origin, Table

Date = str | dt.date

#: Errors that lie in a file, as Spark names them; any other error ends the run.
_FILE_TROUBLE = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException")


def manifest_of(table: Table) -> Manifest:
    """What became of the files that were offered to a table."""
    return Manifest(table.spark, f"{table.path}_files")


def rejects_of(table: Table) -> Table:
    """Where the text of rows goes that a table could not take whole: beside the table."""
    return Table(table.spark, f"{table.path}_rejects", lms.LINE_REJECTS)


def landed_rows(
    df: DataFrame, batch_date: Date, schema: T.StructType, min_rows: int = 1
) -> DataFrame:
    """Scanned drops as landing rows: source columns, size guard, batch date."""
    rows = df.select(*schema.names, csv.SOURCE_FILE, csv.SOURCE_MODIFIED)
    rows = min_rows_guard(rows, [csv.SOURCE_FILE], min_rows)
    return stamp_batch(rows, batch_date, lms.BATCH)


def ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: Table,
    batch_date: Date,
    schema: T.StructType = lms.EXTRACT,
    min_rows: int = 1,
    check_header: bool = True,
    required: Sequence[str] | None = None,
) -> int:
    """Land the drops under ``paths`` that have not been taken yet.

    Only ``*.csv`` and ``*.csv.gz`` names count.  Files with fewer than ``min_rows`` data rows
    are skipped; 2 also skips files of one row.  Returns the number of files
    landed or skipped.

    Columns bind by header name: they may be reordered, missing (null) or
    unknown (left out, and noted in the manifest).  A header that does not
    match (see ``headers.match``), or a file that cannot be read, puts that
    file in quarantine and lands the others.  ``required`` are the columns a
    header must have, by default the extract's keys.  Without ``check_header``
    columns bind by position and headers are not looked at.

    A line that does not fit the schema lands with nulls, and its text goes to
    ``rejects_of(table)`` from the same scan.  A run that dies between the two
    commits leaves that text there twice rather than not at all.
    """
    day = date_of(batch_date).isoformat()
    return land_new(files.listing(spark, paths), table, day, schema, min_rows, check_header, required)


def land_new(
    listing: DataFrame,
    table: Table,
    day: str,
    schema: T.StructType = lms.EXTRACT,
    min_rows: int = 1,
    check_header: bool = True,
    required: Sequence[str] | None = None,
) -> int:
    """Land the listed files that the manifest has no outcome for; only file names pass through the driver."""
    if required is None:
        required = [k for k in lms.KEYS if k in schema.names]
    manifest = manifest_of(table)
    _seed(manifest, table)
    new = {row.path: row for row in manifest.unseen(listing.select("path", "modified")).collect()}
    for outcome in _survivors(manifest, listing, table, new):
        manifest.record([outcome])
        del new[outcome.path]
    manifest.record(Outcome(row.path, row.modified, CLAIMED, batch=day) for row in new.values())

    groups, refused = _layouts(table.spark, new, schema, check_header, required)
    manifest.record(Outcome(path, new[path].modified, QUARANTINED, reason=reason, batch=day) for path, reason in refused.items())
    taken = [path for paths in groups.values() for path in paths]
    return _land(manifest, table, day, schema, min_rows, groups, {path: new[path] for path in taken})


def _seed(manifest: Manifest, table: Table) -> None:
    """A table from before there were manifests gets one from the files its rows name."""
    if not manifest.exists() and table.exists():
        rows = table.read().groupBy(F.col(csv.SOURCE_FILE).alias("path")).agg(
            F.max(csv.SOURCE_MODIFIED).alias("modified"), F.count(F.lit(1)).alias("rows"))
        manifest.append(rows.select(
            "path", "modified", F.lit(LANDED).alias("state"), "rows",
            F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("batch")))


def _survivors(manifest: Manifest, listing: DataFrame, table: Table, new: dict[str, Row]) -> list[Outcome]:
    """Files whose rows a run has committed before it died: claimed, and named by landed rows."""
    claimed = [row.path for row in manifest.unfinished(listing.select("path", "modified")).select("path").distinct().collect()] if new else []
    if not claimed:
        return []
    counts = table.read().filter(F.col(csv.SOURCE_FILE).isin(claimed)).groupBy(csv.SOURCE_FILE).count().collect()
    return [Outcome(row[0], new[row[0]].modified, LANDED, row[1]) for row in counts if row[0] in new]


def _layouts(
    spark: SparkSession, new: dict[str, Row], schema: T.StructType, check_header: bool, required: Sequence[str]
) -> tuple[dict[headers.Layout, list[str]], dict[str, str]]:
    """Files by layout, and those that are refused with the reason."""
    if not check_header:
        return ({headers.by_position(schema): list(new)} if new else {}), {}
    groups: dict[headers.Layout, list[str]] = {}
    refused: dict[str, str] = {}
    for path, header in headers.headers_of(spark, list(new)).items():
        try:
            if isinstance(header, Exception):
                raise ValueError(f"unreadable: {_told(header)}")
            # An empty file has nothing to bind and will have no rows.
            layout = headers.match(header, schema, required) if header else headers.by_position(schema)
        except ValueError as error:
            refused[path] = str(error)
        else:
            groups.setdefault(layout, []).append(path)
    return groups, refused


def _land(
    manifest: Manifest, table: Table, day: str, schema: T.StructType, min_rows: int,
    groups: dict[headers.Layout, list[str]], taken: dict[str, Row],
) -> int:
    """Land files in one go; if one of them cannot be read, the halves apart, down to that file."""
    if not taken:
        return 0
    try:
        counts = land(headers.scan_layouts(table.spark, groups, schema), table, day, schema, min_rows)
    except (PySparkException, Py4JJavaError) as error:
        if not any(name in str(error) for name in _FILE_TROUBLE):
            raise
        if len(taken) == 1:
            [(path, row)] = taken.items()
            manifest.record([Outcome(path, row.modified, QUARANTINED, reason=f"unreadable: {_told(error)}", batch=day)])
            return 0
        paths = list(taken)
        halves = paths[: len(paths) // 2], paths[len(paths) // 2 :]
        return sum(
            _land(manifest, table, day, schema, min_rows,
                  {layout: own for layout, all_ in groups.items() if (own := [p for p in all_ if p in set(half)])},
                  {path: taken[path] for path in half})
            for half in halves)
    note = {path: layout.note for layout, paths in groups.items() for path in paths}
    manifest.record(
        Outcome(path, row.modified, LANDED if counts.get(path, 0) >= max(min_rows, 1) else SKIPPED, counts.get(path, 0), note[path], day)
        for path, row in taken.items())
    return len(taken)


def _told(error: Exception) -> str:
    return str(error).strip().splitlines()[0][:300]


def _malformed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(csv.CORRUPT).isNotNull()).select(
        csv.SOURCE_FILE, F.col(csv.CORRUPT).alias("Line"), F.lit("malformed line").alias("Reason"))


def land(
    drops: DataFrame,
    table: Table,
    day: str,
    schema: T.StructType,
    min_rows: int = 1,
    stream: tuple[str, int] | None = None,
) -> dict[str, int]:
    """Append scanned drops to a landing table, and the text of malformed lines to its rejects.

    Returns the number of rows of each file that has any.  The rows are
    written once, straight into the table; only a size guard has to see all of
    them first.
    """
    origin, found = Origin(batch=day, stream=stream), {}
    if min_rows <= 1:
        watch = Observation()

        def before_commit(written: DataFrame) -> None:
            found.update({row[csv.SOURCE_FILE]: row["count"] for row in written.groupBy(csv.SOURCE_FILE).count().collect()})
            if watch.get["bad"]:
                # All columns are stored, so that lines are judged by the same ones again.
                with staged(drops.filter(F.col(csv.CORRUPT).isNotNull()), "bad-lines") as rows:
                    rejects_of(table).append(stamp_batch(_malformed(rows), day, lms.BATCH), origin)

        seen = drops.observe(watch, F.count(csv.CORRUPT).alias("bad"))
        table.append(landed_rows(seen, day, schema), origin, before_commit=before_commit)
        return found
    with staged(drops, "drops") as rows:
        counts = rows.groupBy(csv.SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"), F.count(csv.CORRUPT).alias("bad")).collect()
        if any(row.bad for row in counts):
            rejects_of(table).append(stamp_batch(_malformed(rows), day, lms.BATCH), origin)
        table.append(landed_rows(rows, day, schema, min_rows), origin)
    return {row[csv.SOURCE_FILE]: row["rows"] for row in counts}
