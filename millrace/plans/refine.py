"""The layers: landing, bronze, silver and the star schema, one batch date at a time.

Each step reads its input from the layer above, writes one new version of its
own table and records the batch in that version's commit.  A step that fails
raises and records nothing; a step whose input was taken already does nothing.
Days and files may come late or out of order: each column of a row keeps the
value of its newest writer.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import date_of
from millrace.operators.dedup import has_doubles
from millrace.operators.incremental import batch_of, pending_batches, stamp_batch
from millrace.operators.lastwriter import RANKS, fold, ranked
from millrace.operators.quality import is_missing
from millrace.operators.rejects import settle
from millrace.plans import conform as conforming
from millrace.plans import lms, star
from millrace.plans.audits import Audits, counted
from millrace.plans.landing import Date, ingest, land, rejects_of
from millrace.plans.specs import ConformSpec
from millrace.sources import csv
from millrace.sources.tables import Origin, Table

__all__ = ["Date", "Layers", "audit", "bronze", "gold", "ingest", "land", "pending", "rejects_of", "silver"]


class Layers:
    """The tables of the learning-management extract below one root folder."""

    def __init__(self, spark: SparkSession, root: str, spec: ConformSpec = lms.CONFORM):
        self.spark = spark
        self.spec = spec
        root = root.rstrip("/")

        def table(name: str, schema: T.StructType, partition_by: str | None = lms.BATCH) -> Table:
            return Table(spark, f"{root}/{name}", schema, partition_by)

        self.landing = table("landing", lms.LANDING)
        self.bronze = table("bronze_data", lms.BRONZE_STORED)
        self.bronze_rejects = table("bronze_rejects", lms.REJECTS)
        self.silver = table("silver_data", lms.SILVER)
        self.silver_rejects = table("silver_rejects", lms.REJECTS)
        self.audits = {"bronze": audits_of(self.bronze), "silver": audits_of(self.silver)}
        self.star = {
            s.name: table(s.name, s.schema, s.partition_by)
            for s in (*lms.STAR.dimensions, lms.STAR.fact)
        }

    @property
    def fact(self) -> Table:
        return self.star[lms.STAR.fact.name]

    def refresh(self, batch_date: Date) -> None:
        """Take one landed batch through all layers."""
        bronze(self.landing, self.bronze, self.bronze_rejects, batch_date)
        silver(self.bronze, self.silver, self.silver_rejects, batch_date, self.spec)
        gold(self.silver, self.star, batch_date)

    def refresh_pending(self) -> None:
        """Take everything that landed, late drops included, through all layers."""
        for day in pending(self.landing, self.bronze):
            bronze(self.landing, self.bronze, self.bronze_rejects, day)
        for day in pending(self.bronze, self.silver):
            silver(self.bronze, self.silver, self.silver_rejects, day, self.spec)
        for day in pending(self.silver, self.fact):
            gold(self.silver, self.star, day)


def pending(upstream: Table, downstream: Table) -> list[str]:
    """Batch dates that changed upstream since downstream last took them, oldest first."""
    waiting = pending_batches(upstream.batches(), downstream.used(), ["batch", "revision"])
    return [row.batch for row in waiting.select("batch").orderBy("batch").collect()]


def drop_rank(day: str) -> Column:
    """The rank of a landed row: by batch date, then by the time its file was last changed."""
    millis = F.unix_millis(F.coalesce(F.col(csv.SOURCE_MODIFIED), F.lit("1970-01-01 00:00:00").cast("timestamp")))
    return F.lit(date_of(day).toordinal()).cast("long") * F.lit(1 << 43) + millis


def bronze(landing: Table, table: Table, rejects: Table, batch_date: Date) -> None:
    """Merge a landed batch into bronze: one row per key, first-seen date kept.

    Each column keeps the value of its last writer (by batch date, then by file
    time), so days and files may come in any order.  Rows that a late batch
    changes are marked with it, so that the layers below take them.
    """
    day = date_of(batch_date).isoformat()
    revision = landing.snapshot().last.get(day)
    if _taken(table, day, revision):
        return
    batch = batch_of(landing.read_batch(day), day, lms.BATCH)
    reason = F.when(is_missing(lms.KEYS), "missing key")
    _take_rejects(rejects, batch.withColumn("Reason", reason), "bronze", day, audits_of(table))
    keyed = batch.filter(reason.isNull())
    # Where a key comes twice, each column takes the value of the newest file that has one.
    rows = ranked(keyed, lms.FOLDED, drop_rank(day))
    if has_doubles(keyed, lms.KEYS):
        rows = fold(rows, lms.KEYS)
    rows = rows.select(*lms.EXTRACT.names, RANKS)
    for column in (lms.BATCH, lms.LAST_BATCH, lms.NEWEST_BATCH):
        rows = stamp_batch(rows, day, column)
    table.merge(
        rows,
        lms.KEYS,
        first_wins=[lms.BATCH],
        origin=Origin(batch=day, used=revision),
        newest_by=lms.NEWEST_BATCH,
        touched_by=lms.LAST_BATCH,
        ranks=RANKS,
        unique=True,
    )


def silver(
    bronze_table: Table,
    table: Table,
    rejects: Table,
    batch_date: Date,
    spec: ConformSpec = lms.CONFORM,
) -> None:
    """Conform the bronze rows a batch brought or changed, and merge them.

    Bronze has one row per key, so there are no repeated rows to remove.
    """
    day = date_of(batch_date).isoformat()
    revision = bronze_table.snapshot().last.get(day)
    if _taken(table, day, revision):
        return
    batch = batch_of(bronze_table.read_batch(day), day, lms.LAST_BATCH).drop(RANKS)
    judged = batch.withColumn(conforming.REASON, conforming.reject_reason(spec))
    _take_rejects(rejects, judged, "silver", day, audits_of(table))
    rows = conforming.conform(batch, spec, unique=True)
    _settle(rejects, batch.filter(conforming.reject_reason(spec).isNull()), day)
    table.merge(rows, lms.KEYS, first_wins=[lms.BATCH], origin=Origin(batch=day, used=revision), unique=True)


def audit(bronze_table: Table, batch_date: Date, spec: ConformSpec = lms.CONFORM) -> DataFrame:
    """How many rows of a batch silver keeps, and how many it rejects by reason."""
    day = date_of(batch_date).isoformat()
    batch = batch_of(bronze_table.read_batch(day), day, lms.LAST_BATCH).drop(RANKS)
    return conforming.audit(batch, spec)


def audits_of(table: Table) -> Audits:
    """The counts of the steps that fill a table: beside it."""
    return Audits(table.spark, f"{table.path}_audits")


def gold(silver_table: Table, tables: dict[str, Table], batch_date: Date) -> None:
    """Merge a batch of silver rows into the dimensions, then into the fact.

    A dimension row is that of the newest batch.  When newer batches are in
    already, the rows of this one cannot tell, so the dimension keys it brings
    are looked up among all silver rows.
    """
    day = date_of(batch_date).isoformat()
    known = silver_table.snapshot().last
    revision = known.get(day)
    batch = batch_of(silver_table.read_batch(day), day, lms.LAST_BATCH)
    origin = Origin(batch=day, used=revision)
    overtaken = any(other > day for other in known)
    for spec in (*lms.STAR.dimensions, lms.STAR.fact):
        if _taken(tables[spec.name], day, revision):
            continue
        rows = batch
        if overtaken and spec is not lms.STAR.fact:
            # Distinct keys are counted before Spark may broadcast them; a scan's files tell too little.
            rows = silver_table.read().join(batch.select(*spec.keys).distinct(), list(spec.keys), "left_semi")
        spec = replace(spec, newest_by=(lms.NEWEST_BATCH, *spec.newest_by))
        star.merge_into(tables[spec.name], rows, spec, origin, unique_on=lms.KEYS)


def _taken(table: Table, day: str, revision: int | None) -> bool:
    """Whether a table has taken this very version of a batch, or there is none."""
    return table.snapshot().used.get(day) == revision


def _take_rejects(table: Table, judged: DataFrame, stage: str, day: str, audits: Audits) -> None:
    """Count rows read, kept and rejected while looking for rejects, and replace those of the day.

    That pass reads the columns a reason depends on, no others.  Where there
    are no rejects, and were none before, nothing is committed.
    """
    rejected = F.col("Reason").isNotNull()
    reasons, watch = counted(judged.select("Reason"), rejected)
    reasons.write.format("noop").mode("overwrite").save()
    counts = watch.get
    if counts["n_rejected"] or table.exists():
        rows = stamp_batch(judged.filter(rejected).withColumn("Stage", F.lit(stage)), day, lms.BATCH)
        table.overwrite(rows, emptied=[day], balance=False)
    audits.record(stage, day, counts)


def _settle(table: Table, entered: DataFrame, day: str) -> None:
    """Rows that pass now leave the rejects of earlier days."""
    if not table.exists():
        return
    waiting = table.read().filter(F.col(lms.BATCH) != day)
    if waiting.isEmpty():
        return
    # As distinct keys, their size is known before Spark may broadcast them.
    days = [row[0] for row in waiting.join(entered.select(*lms.KEYS).distinct(), list(lms.KEYS), "left_semi").select(lms.BATCH).distinct().collect()]
    if days:
        table.overwrite(settle(waiting.filter(F.col(lms.BATCH).isin(days)), entered, lms.KEYS), emptied=days)
