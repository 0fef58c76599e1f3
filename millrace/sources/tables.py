"""Parquet tables that are read as snapshots and changed one version at a time.

Layout below the table's path::

    data/_version=3-5f0c/Processing_Date=2024-01-15/part-*.parquet   rows written by version 3
    commits/_version=3.json                                          what version 3 consists of

A version's commit lists the data folders it is made of, most of them written
by earlier versions, plus the batches merged so far.  It is published by a
rename after Spark's job has written all rows, and readers take the newest
one: a job that dies leaves a folder no reader looks at.  Data and run ledger
change together because they are in the same commit.  Each attempt writes into
a folder of its own, and a version can be published once, so of two writers
the later one fails and has changed nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import require_unique
from millrace.operators.merge import aligned, merge
from millrace.session import fits_broadcast, staged
from millrace.sources import files

_VERSION = "_version"
#: The field in which the keys of both sides of a merge are marked has two to the power of this bits at most: 16 MB.
SLOT_BITS = 27
#: Words of 64 bits in a row of that field, as a power of two.
STRETCH_BITS = 9
#: Dates up to which each task of a shuffled merge writes into all.
FEW_DATES = 8
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Snapshot:
    """One version: its data folders and the run ledgers.

    ``first`` and ``last`` give, per batch, the versions that merged it first
    and last; ``used`` gives the upstream version a batch was taken from;
    ``stream`` gives the last micro-batch by the id of the stream.  The size follows the
    number of partitions and batch dates, not of rows.
    """

    version: int = 0
    folders: tuple[str, ...] = ()
    first: dict[str, int] = field(default_factory=dict)
    last: dict[str, int] = field(default_factory=dict)
    used: dict[str, int] = field(default_factory=dict)
    stream: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Origin:
    """What a write stands for, to be recorded in its commit."""

    batch: str | None = None
    used: int | None = None  # upstream version the batch was taken from
    stream: tuple[str, int] | None = None  # stream id and micro-batch number


def _version_of(path: str) -> int:
    return int(re.search(rf"{_VERSION}=(\d+)", path).group(1))


def _partition_of(folder: str) -> str:
    return unquote(folder.partition("/")[2])


def _partition_name(column: str, value: str | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


class Table:
    """A table with a declared schema, optionally split by one partition column."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition_by: str | None = None,
    ):
        if _VERSION in schema.names:
            raise ValueError(f"column name {_VERSION} is taken")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by

    # -- reading -----------------------------------------------------------

    def _versions(self) -> list[int]:
        found = files.glob(self.spark, f"{self.path}/commits/{_VERSION}=*.json")
        return sorted(_version_of(path.rpartition("/commits/")[2]) for path in found)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A committed version, by default the newest; version 0 is the empty table."""
        if version is None:
            version = max(self._versions(), default=0)
        if version == 0:
            return Snapshot()
        text = files.read_text(self.spark, f"{self.path}/commits/{_VERSION}={version}.json")
        content = json.loads(text)
        return Snapshot(**content | {"folders": tuple(content["folders"])})

    def exists(self) -> bool:
        return self.snapshot().version > 0

    def read(self) -> DataFrame:
        """The current rows; an empty frame of the declared schema before any write."""
        return self._rows(self.snapshot().folders)

    def read_batch(self, batch: str) -> DataFrame:
        """Folders that can hold rows of a batch: those written at or after its merge.

        A superset to filter, which spares the scan of all older partitions.
        """
        now = self.snapshot()
        first = now.first.get(batch)
        if first is None:
            return self._rows(())
        return self._rows([f for f in now.folders if _version_of(f) >= first])

    def batches(self) -> DataFrame:
        """The run ledger: each batch with the version that merged it last."""
        return self._ledger("last")

    def used(self) -> DataFrame:
        """Each batch with the upstream version it was last taken from."""
        return self._ledger("used")

    def _ledger(self, kind: str) -> DataFrame:
        rows = sorted(getattr(self.snapshot(), kind).items())
        return self.spark.createDataFrame(rows, "batch string, revision bigint")

    def _rows(self, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/data/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*self.schema.names)

    # -- writing -----------------------------------------------------------

    def create(self) -> None:
        """Commit an empty first version unless the table is there already."""
        if not self.exists():
            self._commit(Snapshot(version=1))

    def append(
        self, df: DataFrame, origin: Origin = Origin(), balance: bool = False,
        before_commit: Callable[[DataFrame], None] | None = None,
    ) -> bool:
        """Add rows in new folders, and tell whether there were any.

        A micro-batch that is in already is skipped.  Rows of one batch date
        are written where they are; ask for ``balance`` when the frame spans
        many partitions, or each task writes into all.  ``before_commit`` gets
        the rows that were written, if any, before a reader can see them.
        """
        now = self.snapshot()
        if _done(now, origin):
            return False
        written = self._write(df, now.version + 1, balance)
        if not written:
            return False
        if before_commit is not None:
            before_commit(self._rows(written))
        self._commit(_next(now, [*now.folders, *written], origin))
        return True

    def overwrite(
        self, df: DataFrame, origin: Origin = Origin(), emptied: Iterable[str] = (), balance: bool = True
    ) -> None:
        """Replace the partitions that the frame has rows for (all, if unpartitioned).

        Partition values in ``emptied`` are replaced even if no row is left for them.
        Rows of one date need no ``balance``.
        """
        now = self.snapshot()
        written = self._write(df, now.version + 1, balance)
        gone = {_partition_of(f) for f in written}
        gone |= {_partition_name(self.partition_by, value) for value in emptied}
        kept = [f for f in now.folders if self.partition_by and _partition_of(f) not in gone]
        self._commit(_next(now, [*kept, *written], origin))

    def merge(
        self,
        incoming: DataFrame,
        keys: Sequence[str],
        first_wins: Sequence[str] = (),
        null_policy: str = "keep_old",
        strategy: str = "auto",
        origin: Origin = Origin(),
        newest_by: str | None = None,
        touched_by: str | None = None,
        ranks: str | None = None,
        unique: bool = False,
    ) -> bool:
        """Upsert a batch and rewrite only the partitions that hold its keys.

        Those are found by a scan of the key columns alone; rows with new keys
        go to new folders.  A doubled key in ``incoming`` raises and changes
        nothing; callers that have made the keys ``unique`` themselves say so.
        The batch is read several times, so it is staged once (a unique first
        load is written as it is).  Merging the same batch again changes nothing.

        A small batch causes no shuffle at all: rewritten rows stay in the
        splits they were read in.  Of a large one only the rows whose key may
        be on both sides are shuffled whole (see ``_met``); the others stay in
        their splits.  The shuffled join scatters dates over its tasks, so
        where there are many its output is gathered by date again.  A batch
        without stored keys is written as it is, which suits a batch of one date; load many
        dates with ``append(balance=True)``.
        """
        now = self.snapshot()
        if _done(now, origin):
            return False
        incoming = aligned(incoming, self.schema)
        if not now.folders and unique:
            written = self._write(incoming, now.version + 1, balance=False)
            self._commit(_next(now, written, origin))
            return True
        with staged(incoming) as batch:
            if not unique:
                require_unique(batch, keys, complete=False)
            touched = now.folders
            if touched and strategy == "auto":
                strategy = "patch" if fits_broadcast(batch) else "full_outer"

            def merged(old: DataFrame, new: DataFrame) -> DataFrame:
                return merge(old, new, keys, first_wins, null_policy, strategy, newest_by, touched_by, ranks)

            if touched and strategy == "full_outer":
                bits = _slot_bits(batch)
                with staged(self._met(now, batch, keys, bits), "met") as met:
                    if self.partition_by:
                        touched = self._folders_of(now, met.select(F.explode("dates").alias("date")).distinct())
                    if touched:
                        met = met.drop("dates")
                        old, kept_old = _parted(self._rows(touched), met, keys, bits)
                        new, kept_new = _parted(batch, met, keys, bits)
                        moved = merged(old, new).unionByName(kept_new)
                        dates = {_partition_of(f) for f in touched}
                        if self.partition_by and (origin.batch is None or len(dates) > FEW_DATES):
                            moved = moved.hint("rebalance", F.col(self.partition_by))
                        batch = moved.unionByName(kept_old)
                    written = self._write(batch, now.version + 1, balance=False)
            else:
                if touched and self.partition_by:
                    touched = self._partitions_with(now, batch, keys)
                if touched:
                    batch = merged(self._rows(touched), batch)
                written = self._write(batch, now.version + 1, balance=False)
        kept = [f for f in now.folders if f not in touched]
        self._commit(_next(now, [*kept, *written], origin))
        return True

    def remove_unused(self, keep: int = 1) -> int:
        """Delete data folders that none of the newest ``keep`` versions uses.

        Rewritten partitions leave their old folders behind; readers that are
        still on an older version than those kept lose them.  What a running
        write has put down so far stays.  Returns how many folders went.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self._versions()
        used = {f for version in versions[-keep:] for f in self.snapshot(version).folders}
        depth = "/*=*" if self.partition_by else ""
        found = files.glob(self.spark, f"{self.path}/data/{_VERSION}=*{depth}")
        names = {path.rpartition("/data/")[2]: path for path in found}
        newest = max(versions, default=0)
        stale = [p for name, p in names.items() if name not in used and _version_of(name) <= newest]
        for path in stale:
            files.delete(self.spark, path)
        return len(stale)

    def _partitions_with(
        self, now: Snapshot, incoming: DataFrame, keys: Sequence[str]
    ) -> tuple[str, ...]:
        """Folders of the partitions in which a key of the batch is stored.

        Only distinct partition values reach the driver: one per batch date.
        """
        column = self.partition_by
        hits = (
            self._rows(now.folders)
            .select(*keys, column)
            .join(incoming.select(*keys), list(keys), "left_semi")
            .select(F.col(column).cast("string"))
            .distinct()
        )
        return self._folders_of(now, hits)

    def _met(self, now: Snapshot, incoming: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
        """_stretch, _words, dates: where the hashes of the keys lie that are stored and come again.

        Keys meet as 64-bit hashes.  Those on both sides are marked in a field
        of ``2**bits`` bits, so it can be broadcast at any size: a row has a
        stretch of it as an array of words, as a row for each word would take
        the driver many times the field's size.  Keys that share a bit by
        chance are shuffled for nothing.  The batch is a large one, and is not
        to be broadcast here because its files are small.
        """
        date = F.col(self.partition_by).cast("string") if self.partition_by else F.lit(None).cast("string")
        stored = _hashed(self._rows(now.folders), keys).select("_hash", date.alias("date"))
        both = stored.join(_hashed(incoming, keys).select("_hash").hint("merge"), "_hash", "left_semi")
        # A null date is kept, as the empty set's place holder is not.
        marks = both.select(_word(bits).alias("word"), _bit().alias("bit"), F.array("date").alias("date"))
        blank = self.spark.range(1 << (bits - 6)).select(
            F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"), F.array().cast("array<string>").alias("date"))
        words = marks.unionByName(blank).groupBy("word").agg(
            F.bit_or("bit").alias("bits"), F.flatten(F.collect_set("date")).alias("dates"))
        in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
        return words.groupBy(F.shiftright("word", STRETCH_BITS).alias("_stretch")).agg(
            F.transform(in_order, lambda word: word["bits"]).alias("_words"),
            F.array_distinct(F.flatten(F.collect_list("dates"))).alias("dates"))

    def _folders_of(self, now: Snapshot, dates: DataFrame) -> tuple[str, ...]:
        names = {_partition_name(self.partition_by, row[0]) for row in dates.collect()}
        return tuple(f for f in now.folders if _partition_of(f) in names)

    def _write(self, df: DataFrame, version: int, balance: bool) -> list[str]:
        """Write the rows of a version and list the folders that came out.

        ``balance`` spreads a partition over as many files as its size asks
        for; Spark splits large ones and joins small ones at run time.
        """
        folder = f"{_VERSION}={version}-{uuid.uuid4().hex[:8]}"
        target = f"{self.path}/data/{folder}"
        df = df.select(*self.schema.names)
        if not self.partition_by:
            df.write.option("compression", COMPRESSION).parquet(target)
            return [folder]
        if balance:
            df = df.hint("rebalance", F.col(self.partition_by))
        df.write.option("compression", COMPRESSION).partitionBy(self.partition_by).parquet(target)
        found = files.glob(self.spark, f"{target}/{self.partition_by}=*")
        return [f"{folder}/" + f.rstrip("/").rsplit("/", 1)[1] for f in found]

    def _commit(self, snapshot: Snapshot) -> None:
        target = f"{self.path}/commits/{_VERSION}={snapshot.version}.json"
        files.publish_text(self.spark, target, json.dumps(asdict(snapshot), indent=1))


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a key, and its hash."""
    return df.na.drop(how="any", subset=list(keys)).withColumn("_hash", F.xxhash64(*keys))


def _slot_bits(batch: DataFrame) -> int:
    """The size of the field for a batch: 16 bits or more for each row, up to ``SLOT_BITS``."""
    return max(6, min(SLOT_BITS, (16 * batch.count()).bit_length()))


def _word(bits: int) -> Column:
    """The word that a hash falls into."""
    return F.shiftright(F.col("_hash").bitwiseAND((1 << bits) - 1), 6)


def _bit() -> Column:
    """A hash's bit in its word."""
    return F.expr("shiftleft(1L, cast(_hash & 63 as int))")


def _parted(df: DataFrame, met: DataFrame, keys: Sequence[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be on both sides (see ``Table._met``), and those whose key surely is not."""
    places = df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_stretch", F.shiftright(_word(bits), STRETCH_BITS))
    word = F.get("_words", _word(bits).bitwiseAND((1 << STRETCH_BITS) - 1).cast("int"))
    marked = F.coalesce(word.bitwiseAND(_bit()) != 0, F.lit(False))
    known = places.join(F.broadcast(met), "_stretch", "left")
    return known.filter(marked).select(*df.columns), known.filter(~marked).select(*df.columns)


def _done(now: Snapshot, origin: Origin) -> bool:
    return origin.stream is not None and now.stream.get(origin.stream[0], -1) >= origin.stream[1]


def _next(now: Snapshot, folders: Iterable[str], origin: Origin) -> Snapshot:
    version = now.version + 1
    following = replace(now, version=version, folders=tuple(folders))
    if origin.batch is not None:
        following = replace(
            following,
            first={origin.batch: version, **now.first},
            last={**now.last, origin.batch: version},
        )
        if origin.used is not None:
            following = replace(following, used={**now.used, origin.batch: origin.used})
    if origin.stream is not None:
        name, number = origin.stream
        following = replace(following, stream={**now.stream, name: number})
    return following
