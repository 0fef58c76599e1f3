import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators.lastwriter import RANKS, ranked
from millrace.operators.merge import merge
from millrace.plans.specs import schema_of
from millrace.sources.buckets import SLOT, BucketedTable
from millrace.sources.clustered import key_ranges, near_keys, write_clustered
from millrace.sources.checked import checksum, write_checked
from millrace.sources.tables import Table

SCHEMA = schema_of("k bigint, v string, w int")


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "t"), SCHEMA, ["k"], 8)
    yield made
    spark.sql(f"drop table if exists {made.name}")


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k bigint, v string, w int")


def test_merges_equal_the_plain_upsert(spark, table, rows):
    assert table.read().count() == 0
    table.merge(frame(spark, *[(n, f"v{n}", n) for n in range(100)]))
    touched = table.merge(frame(spark, (3, "new", None), (200, "x", 1)))
    assert len(touched) <= 2
    expected = {n: (n, f"v{n}", n) for n in range(100)} | {3: (3, "new", 3), 200: (200, "x", 1)}
    assert rows(table.read()) == sorted(expected.values(), key=repr)
    assert table.merge(frame(spark)) == []


def test_only_touched_buckets_are_read_and_written(spark, table, tmp_path):
    table.merge(frame(spark, *[(n, "a", 0) for n in range(200)]))

    def stamps():
        return {p.parent.name: p.stat().st_mtime_ns for p in sorted((tmp_path / "t").rglob("*.parquet"))}

    before = stamps()
    touched = table.merge(frame(spark, (5, "b", 1)))
    changed = {name for name, at in stamps().items() if before[name] != at}
    assert changed == {f"{SLOT}={touched[0]}"} and len(before) == 8


def test_stored_side_is_not_shuffled(spark, table, plan):
    table.merge(frame(spark, *[(n, "a", 0) for n in range(200)]))
    text = plan(merge(table._stored([1, 2]), frame(spark, (5, "b", 1)), ["k"], strategy="full_outer"))
    left, _, right = text.partition("FullOuter")[2].partition("Exchange")
    assert "Bucketed: true" in left and "PartitionFilters" in left and "Scan parquet" in left.replace("FileScan parquet", "Scan parquet")
    assert "Scan parquet" not in right.replace("FileScan parquet", "Scan parquet")


def test_a_new_session_finds_the_table(spark, table, rows):
    table.merge(frame(spark, (1, "a", 0), (2, "b", 0)))
    again = BucketedTable(spark, f"{table.name}_again", table.path, SCHEMA, ["k"], 8)
    assert rows(again.read()) == [(1, "a", 0), (2, "b", 0)]
    again.merge(frame(spark, (2, "c", None)))
    assert rows(again.read()) == [(1, "a", 0), (2, "c", 0)]
    spark.sql(f"drop table {again.name}")


def test_ranks_and_first_wins(spark, tmp_path, rows):
    plain = frame(spark, (1, "old", 1))
    schema = ranked(plain, ["v"], F.lit(1)).schema
    table = BucketedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "r"), schema, ["k"], 4)
    for rank, value, w in ((2, "second", 5), (1, "first", 6)):
        table.merge(ranked(frame(spark, (1, value, w)), ["v"], F.lit(rank)), first_wins=["w"], ranks=RANKS)
    assert rows(table.read().select("k", "v", "w")) == [(1, "second", 5)]


@pytest.mark.parametrize("make", [
    lambda spark, path: BucketedTable(spark, f"t_{uuid.uuid4().hex}", path, SCHEMA, ["k"], 4).merge,
    lambda spark, path: lambda df: Table(spark, path, SCHEMA).merge(df, ["k"]),
])
def test_a_doubled_key_raises_and_changes_nothing(spark, tmp_path, make):
    merge = make(spark, str(tmp_path / "t"))
    merge(frame(spark, (1, "a", 0)))
    with pytest.raises(ValueError, match="comes 2 times"):
        merge(frame(spark, (1, "b", 1), (1, "c", 1), (2, "d", 1)))
    found = spark.read.parquet(str(tmp_path / "t")) if not (tmp_path / "t" / "commits").exists() else Table(spark, str(tmp_path / "t"), SCHEMA).read()
    assert [r.v for r in found.collect()] == ["a"]


def test_rows_without_a_key_raise(spark, table):
    with pytest.raises(ValueError, match="without a key"):
        table.merge(frame(spark, (None, "a", 0)))


def rows_scanned(df):
    """Rows that the scan of a frame handed on, after row groups were skipped."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_row_groups_out_of_a_batchs_ranges_are_skipped(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.range(400_000).selectExpr("id as k", "id % 2 as part", "sha2(cast(id as string), 256) as pad")
    write_clustered(rows.repartition(8), path, "part", ["k"], row_group=256 << 10)
    base = spark.read.parquet(path)
    batch = spark.range(1000, 1100).unionByName(spark.range(390_000, 390_050)).selectExpr("id as k")
    hit = near_keys(base, batch, "k").join(batch, "k", "left_semi")
    assert hit.count() == 150
    near = near_keys(base, batch, "k")
    assert near.count() < rows_scanned(near.select("k")) < 400_000 / 5
    assert rows_scanned(base.select("k")) == 400_000
    assert near_keys(base, batch.limit(0), "k").count() == 0


def test_ranges_hold_all_keys(spark):
    batch = spark.createDataFrame([(1,), (2,), (50,), (51,), (None,), (1000,)], "k int")
    ranges = key_ranges(batch, "k", 4)
    assert all(any(a <= k <= b for a, b in ranges) for k in (1, 2, 50, 51, 1000)) and 1 < len(ranges) <= 6
    assert key_ranges(batch.selectExpr("cast(k as string) as k"), "k") == [("1", "51")]


def test_checksum_sees_what_changed(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "x", None)], "k int, a string, b string")
    assert checksum(rows) == checksum(rows.repartition(3).orderBy("b")) and checksum(rows.limit(0)).rows == 0
    assert checksum(rows) != checksum(rows.selectExpr("k", "b as a", "a as b"))
    path = str(tmp_path / "w")
    assert write_checked(rows, lambda df: df.write.parquet(path), lambda: spark.read.parquet(path)).rows == 3
    with pytest.raises(RuntimeError, match="read back"):
        write_checked(rows, lambda df: df.write.parquet(path + "2"), lambda: spark.read.parquet(path + "2").limit(2))
