import pytest
from pyspark.sql import functions as F

from millrace.plans.specs import schema_of
from millrace.sources.tables import Origin, Table

SCHEMA = schema_of("k int, v string, day string")


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), SCHEMA, "day")


@pytest.fixture
def make(spark):
    return lambda *data: spark.createDataFrame(list(data), SCHEMA)


def folders(table):
    """Version and partition of each folder of the newest version."""
    split = [f.partition("/") for f in table.snapshot().folders]
    return {(int(name.removeprefix("_version=").partition("-")[0]), part) for name, _, part in split}


def test_absent_table_reads_as_empty(table, rows):
    assert not table.exists()
    assert rows(table.read()) == [] and table.read().schema == SCHEMA
    table.create()
    table.create()
    assert table.exists() and table.snapshot().version == 1
    assert rows(table.read()) == []


def test_merge_keeps_insert_patch_and_old_rows(table, make, rows):
    table.merge(make((1, "a", "d1"), (2, "b", "d1")), ["k"], ["day"])
    table.merge(make((2, "B", "d2"), (3, "c", "d2")), ["k"], ["day"])
    assert rows(table.read()) == [(1, "a", "d1"), (2, "B", "d1"), (3, "c", "d2")]


def test_a_frame_read_before_a_merge_still_sees_the_old_version(table, make, rows):
    table.append(make((1, "a", "d1"), (2, "b", "d1")))
    before = table.read()
    table.merge(make((1, "A", "d2")), ["k"], ["day"])
    assert rows(before) == [(1, "a", "d1"), (2, "b", "d1")]
    assert rows(table.read()) == [(1, "A", "d1"), (2, "b", "d1")]


def test_only_partitions_with_keys_of_the_batch_are_rewritten(table, make):
    table.append(make((1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")), balance=True)
    table.merge(make((2, "B", "d9"), (4, "d", "d3")), ["k"], ["day"])
    assert folders(table) == {(1, "day=d1"), (2, "day=d2"), (1, "day=d3"), (2, "day=d3")}
    # New keys alone rewrite nothing at all.
    table.merge(make((5, "e", "d1")), ["k"], ["day"])
    assert {(1, "day=d1"), (3, "day=d1")} <= folders(table)
    assert table.read().count() == 5


def test_row_moves_when_the_partition_column_is_not_first_wins(table, make, rows):
    table.append(make((1, "a", "d1"), (2, "b", "d1")))
    table.merge(make((1, "A", "d2")), ["k"])
    assert rows(table.read()) == [(1, "A", "d2"), (2, "b", "d1")]
    table.merge(make((2, "B", "d2")), ["k"])
    assert rows(table.read()) == [(1, "A", "d2"), (2, "B", "d2")]


def test_reading_one_partition_is_pruned(table, make, plan):
    table.append(make((1, "a", "d1"), (2, "b", "d2")), balance=True)
    df = table.read().filter(F.col("day") == "d1")
    assert df.count() == 1
    assert "PartitionFilters: [isnotnull(day" in plan(df)


def test_unpartitioned_table(spark, tmp_path, rows):
    schema = schema_of("k int, v string")
    table = dim = Table(spark, str(tmp_path / "dim"), schema)
    for data in ([(1, "a"), (2, "b")], [(2, None), (3, "c")], [(3, "C")]):
        table.merge(spark.createDataFrame(data, schema), ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "C")]
    assert folders(dim) == {(3, "")}
    table.overwrite(spark.createDataFrame([(9, "z")], schema))
    assert rows(table.read()) == [(9, "z")]


def test_overwrite_replaces_partitions_it_has_rows_for(table, make, rows):
    table.append(make((1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")), balance=True)
    table.overwrite(make((9, "z", "d2")), emptied=["d3"])
    table.overwrite(make((9, "z", "d2")), emptied=["d3"])
    assert rows(table.read()) == [(1, "a", "d1"), (9, "z", "d2")]


def test_files_of_a_write_that_died_are_not_seen_and_can_be_removed(table, make, rows):
    table.append(make((1, "a", "d1")))
    table._write(make((7, "torn", "d1")), 2, balance=False)
    assert rows(table.read()) == [(1, "a", "d1")]
    assert table.remove_unused() == 0  # might be a write that is still running
    table.append(make((2, "b", "d2")))
    assert table.remove_unused() == 1
    assert rows(table.read()) == [(1, "a", "d1"), (2, "b", "d2")]


def test_failed_write_commits_nothing(table, make, rows):
    table.append(make((1, "a", "d1")), Origin(batch="d1"))
    broken = make((1, "x", "d1")).withColumn("v", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        table.merge(broken, ["k"], origin=Origin(batch="d2"))
    assert rows(table.read()) == [(1, "a", "d1")]
    assert rows(table.batches()) == [("d1", 1)]


def test_of_two_writers_the_later_one_fails_and_changes_nothing(table, make, rows, monkeypatch):
    table.append(make((1, "a", "d1")))
    before = table.snapshot()
    table.append(make((2, "b", "d1")))
    monkeypatch.setattr(table, "snapshot", lambda version=None: before)
    with pytest.raises(FileExistsError):
        table.append(make((3, "c", "d1")))
    with pytest.raises(FileExistsError):
        table.merge(make((1, "C", "d1")), ["k"], ["day"])
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "a", "d1"), (2, "b", "d1")]


def test_ledger_and_batch_reads(table, make, rows):
    table.append(make((1, "a", "d1")), Origin(batch="d1", used=11))
    table.append(make((2, "b", "d2")), Origin(batch="d2", used=12))
    assert rows(table.read_batch("d2")) == [(2, "b", "d2")]
    assert rows(table.read_batch("d3")) == []
    table.append(make((3, "c", "d1")), Origin(batch="d1", used=13))
    # The first version of a batch counts for reading, the last one for the ledger.
    assert rows(table.read_batch("d1")) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d1")]
    assert rows(table.batches()) == [("d1", 3), ("d2", 2)]
    assert rows(table.used()) == [("d1", 13), ("d2", 12)]


def test_replayed_micro_batch_is_skipped(table, make, rows):
    assert table.append(make((1, "a", "d1")), Origin(stream=("s", 0)))
    assert not table.append(make((1, "a", "d1")), Origin(stream=("s", 0)))
    assert not table.merge(make((1, "b", "d1")), ["k"], origin=Origin(stream=("s", 0)))
    assert table.append(make((2, "a", "d1")), Origin(stream=("other", 0)))
    assert table.merge(make((1, "c", "d1")), ["k"], origin=Origin(stream=("s", 1)))
    assert rows(table.read()) == [(1, "c", "d1"), (2, "a", "d1")]


def test_partition_values_with_special_characters(table, make, rows):
    table.append(make((1, "a", "x=1/y z"), (2, "b", None)), balance=True)
    assert rows(table.read()) == sorted([(1, "a", "x=1/y z"), (2, "b", None)], key=repr)
    table.merge(make((1, "A", "d"), (2, "B", "d")), ["k"], ["day"])
    assert rows(table.read()) == sorted([(1, "A", "x=1/y z"), (2, "B", "d")], key=repr)


def test_unused_folders_can_be_removed(spark, table, make, rows, tmp_path):
    table.append(make((1, "a", "d1"), (2, "b", "d2")), balance=True)
    table.merge(make((1, "A", "d3"), (3, "c", "d3")), ["k"], ["day"])
    before = rows(table.read())
    assert table.remove_unused(keep=2) == 0
    assert table.remove_unused() == 1  # the old d1
    assert rows(table.read()) == before == [(1, "A", "d1"), (2, "b", "d2"), (3, "c", "d3")]
    dim = Table(spark, str(tmp_path / "dim"), SCHEMA)
    for v in "xyz":
        dim.merge(make((1, v, "d")), ["k"])
    assert dim.remove_unused() == 2 and rows(dim.read()) == [(1, "z", "d")]


@pytest.mark.parametrize("bits", [3, 27])
def test_a_large_merge_shuffles_only_rows_met_on_both_sides(spark, tmp_path, rows, plan, monkeypatch, bits):
    # With few bits many rows meet by chance, which changes nothing.
    monkeypatch.setattr("millrace.sources.tables.SLOT_BITS", bits)
    base = [(k, f"old{k}", "d1" if k % 2 else None) for k in range(40)] + [(None, "no key", "d1")]
    new = [(k, f"new{k}" if k % 3 else None, "d2") for k in range(30, 60)]
    results = []
    for strategy in ("patch", "full_outer"):
        table = Table(spark, str(tmp_path / f"{strategy}{bits}"), SCHEMA, "day")
        table.append(spark.createDataFrame(base, SCHEMA))
        seen = []
        write = table._write
        monkeypatch.setattr(table, "_write", lambda df, *a, **k: (seen.append(df), write(df, *a, **k))[1])
        table.merge(spark.createDataFrame(new, SCHEMA), ["k"], ["day"], strategy=strategy, origin=Origin(batch="b"))
        results.append(rows(table.read()))
    assert results[0] == results[1] and len(results[0]) == 61
    if bits == 27:
        assert "REBALANCE" not in plan(seen[0]).upper() and plan(seen[0]).count("BroadcastHashJoin") >= 4


def test_the_field_of_a_large_merge_is_a_few_long_rows(spark, tmp_path, rows, monkeypatch):
    # A row for each word of the field takes the driver many times the field's size.
    table = Table(spark, str(tmp_path / "field"), SCHEMA, "day")
    table.append(spark.range(3000).selectExpr("cast(id as int) as k", "'old' as v", "'d1' as day"))
    sent = []
    broadcast = F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: (sent.append(df.count()), broadcast(df))[1])
    batch = spark.range(1000, 4000).selectExpr("cast(id as int) as k", "'new' as v", "'d2' as day")
    table.merge(batch, ["k"], ["day"], strategy="full_outer", origin=Origin(batch="b"))
    assert sent and max(sent) <= 4
    assert rows(table.read()) == sorted([(k, "new" if k >= 1000 else "old", "d1" if k < 3000 else "d2") for k in range(4000)], key=repr)


def test_a_batch_that_is_small_in_its_files_alone_is_not_broadcast(spark, tmp_path, plan, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="1m")
    table = Table(spark, str(tmp_path / "packed"), SCHEMA)
    table.append(spark.range(10).selectExpr("cast(id as int) as k", "'old' as v", "'d1' as day"))
    batch = spark.range(40_000).selectExpr("cast(id as int) as k", "'the same in every row' as v", "'d2' as day")
    seen = []
    write = table._write
    monkeypatch.setattr(table, "_write", lambda df, *a, **k: (seen.append(df), write(df, *a, **k))[1])
    table.merge(batch, ["k"], unique=True)
    assert "FullOuter" in plan(seen[0]) and table.read().count() == 40_000
    table.merge(batch.limit(100), ["k"], unique=True)
    assert "FullOuter" not in plan(seen[1])
