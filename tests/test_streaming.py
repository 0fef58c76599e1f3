import os

import pytest
from pyspark.sql import functions as F

from millrace.plans.refine import Layers, rejects_of
from millrace.plans.specs import schema_of
from millrace.sources import csv
from millrace.sources.tables import Table
from millrace.streaming import drops as streaming
from tests.lms_rows import csv_text, row

SCHEMA = schema_of("k string, v string, n int")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, *lines):
        (tmp_path / "in" / name).write_text("k,v,n\n" + "".join(f"{line}\n" for line in lines))

    write.path = str(tmp_path / "in")
    write.checkpoint = str(tmp_path / "checkpoint")
    return write


def run(spark, folder, handler, **options):
    drops = csv.with_source(csv.scan_stream(spark, folder.path, SCHEMA, **options))
    streaming.run_available(drops, handler, folder.checkpoint)


def test_drops_are_merged_across_restarts(spark, tmp_path, folder, rows):
    table = Table(spark, str(tmp_path / "t"), SCHEMA)
    handler = streaming.merging_into(table, ["k"], [F.col("n").desc_nulls_last()])
    folder("a.csv", "x,old,1", "x,newer,2", "y,kept,1", ",no key,1")
    folder("skip.txt", "z,not csv,1")
    run(spark, folder, handler)
    assert rows(table.read()) == [("x", "newer", 2), ("y", "kept", 1)]
    version = table.snapshot().version
    run(spark, folder, handler)  # nothing new
    assert table.snapshot().version == version
    folder("b.csv", "x,,3", "z,late,1")
    run(spark, folder, handler)
    assert rows(table.read()) == [("x", "newer", 3), ("y", "kept", 1), ("z", "late", 1)]


def test_failed_micro_batch_is_taken_again(spark, tmp_path, folder, rows):
    table = Table(spark, str(tmp_path / "t"), SCHEMA)
    merge = streaming.merging_into(table, ["k"])

    def fails(df, number):
        raise RuntimeError("lost")

    def fails_late(df, number):
        merge(df, number)
        raise RuntimeError("lost after the commit")

    folder("a.csv", "x,1,1")
    for handler in (fails, fails_late):
        with pytest.raises(Exception, match="lost"):
            run(spark, folder, handler)
    version = table.snapshot().version
    run(spark, folder, merge)
    assert rows(table.read()) == [("x", "1", 1)]
    assert table.snapshot().version == version == 1  # the replay was recognised


def test_backlog_in_bounded_micro_batches_oldest_first(spark, tmp_path, folder, rows):
    table = Table(spark, str(tmp_path / "t"), SCHEMA)
    for n, name in enumerate(["c.csv", "b.csv", "a.csv"]):
        folder(name, f"x,{name},{n}")
        os.utime(f"{folder.path}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))
    run(spark, folder, streaming.merging_into(table, ["k"]), max_files=1)
    assert table.snapshot().version == 3
    assert rows(table.read()) == [("x", "a.csv", 2)]


def test_landing_stream_feeds_the_layers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    layers = Layers(spark, str(tmp_path / "tables"))

    def land(day):
        streaming.land_available(
            spark, str(source), layers.landing, day, str(tmp_path / "checkpoint")
        )
        layers.refresh_pending()

    (source / "a.csv").write_text(csv_text(row("1"), row("2")))
    land("2024-01-15")
    (source / "late.csv").write_text(csv_text(row("2", Final_Grade="B"), row("3")))
    land("2024-01-15")
    (source / "c.csv").write_text(csv_text(row("4")))
    land("2024-01-16")
    got = {r.Student_ID: (r.Final_Grade, str(r.Processing_Date)) for r in layers.fact.read().collect()}
    assert got == {
        "1": ("A-", "2024-01-15"), "2": ("B", "2024-01-15"),
        "3": ("A-", "2024-01-15"), "4": ("A-", "2024-01-16"),
    }
    assert layers.landing.read().count() == 5


def test_streams_with_own_checkpoints_feed_one_table(spark, tmp_path, rows):
    merged = Table(spark, str(tmp_path / "merged"), SCHEMA)
    layers = Layers(spark, str(tmp_path / "tables"))
    for n in ("1", "2"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "k.csv").write_text(f"k,v,n\nx{n},v,1\n")
        stream = csv.scan_stream(spark, str(tmp_path / n), SCHEMA)
        streaming.run_available(stream, streaming.merging_into(merged, ["k"]), str(tmp_path / f"c{n}"))
        (tmp_path / f"drops{n}").mkdir()
        (tmp_path / f"drops{n}" / "a.csv").write_text(csv_text(row(n)))
        streaming.land_available(
            spark, str(tmp_path / f"drops{n}"), layers.landing, "2024-01-15", str(tmp_path / f"l{n}")
        )
    assert rows(merged.read()) == [("x1", "v", 1), ("x2", "v", 1)]
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == ["1", "2"]


def test_rebuilt_checkpoint_reads_again_and_merges_the_same(spark, tmp_path, folder, rows):
    table = Table(spark, str(tmp_path / "t"), SCHEMA)
    folder("a.csv", "x,1,1", ",no key,1")
    for n in range(2):
        folder.checkpoint = str(tmp_path / f"checkpoint{n}")
        run(spark, folder, streaming.merging_into(table, ["k"]))
    folder("b.csv", "y,2,1")
    run(spark, folder, streaming.merging_into(table, ["k"]))
    assert rows(table.read()) == [("x", "1", 1), ("y", "2", 1)]


def test_rows_without_a_key_are_kept_as_rejects(spark, tmp_path, folder, rows):
    table = Table(spark, str(tmp_path / "t"), SCHEMA)
    folder("a.csv", "x,1,1", ",no key,1", ",no key,1")
    run(spark, folder, streaming.merging_into(table, ["k"]))
    rejected = rejects_of(table).read().collect()
    assert [r.Reason for r in rejected] == ["missing key"] * 2
    assert '"v":"no key"' in rejected[0].Line and rejected[0].Source_File.endswith("a.csv")
    assert table.read().count() == 1
