import pytest
from pyspark.sql import functions as F

from millrace.operators.incremental import batches_of
from millrace.operators.rejects import corrected, replay, settle
from millrace.plans.audits import Audits, counted
from millrace.plans.refine import Layers, ingest
from tests.lms_rows import csv_text, row

WAITING = "k int, a int, b string, day string"


def test_rejects_enter_or_go_on_waiting(spark, rows):
    rejects = spark.createDataFrame([(1, 5, "x", "d1"), (2, None, "y", "d1"), (3, 1, "z", "d2"), (None, 9, "n", "d2")], WAITING)
    fixes = spark.createDataFrame([(1, 50, 1), (2, None, 1), (9, 99, 1)], "k int, a int, extra int")
    assert rows(corrected(rejects, fixes, ["k"])) == sorted(
        [(1, 50, "x", "d1"), (2, None, "y", "d1"), (3, 1, "z", "d2"), (None, 9, "n", "d2")], key=repr)
    entered, waiting = replay(rejects, fixes, ["k"], F.col("a") > 10)
    assert rows(entered) == [(1, 50, "x", "d1")] and waiting.count() == 3
    assert rows(settle(rejects, entered, ["k"]).select("k")) == sorted([(2,), (3,), (None,)], key=repr)
    assert settle(rejects, entered.withColumn("day", F.lit("d2")), ["k"], ["day"]).count() == 4


def test_a_correction_takes_a_row_out_of_the_rejects(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "t"))
    days = {"2024-01-15": [row("1", Completion_Date="1/1/2020"), row("2"), row("3", Completion_Date="1/1/2020"), row(None)],
            "2024-01-16": [row("1"), row("4")]}
    for day, content in days.items():
        folder = tmp_path / day
        folder.mkdir()
        (folder / "d.csv").write_text(csv_text(*content))
        ingest(spark, str(folder), layers.landing, day)
        layers.refresh_pending()
    assert [r.Student_ID for r in layers.silver_rejects.read().collect()] == ["3"]
    assert sorted(r.Student_ID for r in layers.fact.read().collect()) == ["1", "2", "4"]
    found = {(r.layer, r.batch): (r.n_read, r.n_kept, r.n_rejected) for a in layers.audits.values() for r in a.latest().collect()}
    assert found == {("bronze", "2024-01-15"): (4, 3, 1), ("silver", "2024-01-15"): (3, 1, 2),
                     ("bronze", "2024-01-16"): (2, 2, 0), ("silver", "2024-01-16"): (2, 2, 0)}


def test_counts_ride_on_the_pass_that_is_run(spark, tmp_path, plan):
    spark.range(10).selectExpr("id", "if(id % 5 = 0, 'bad', null) as Reason").write.parquet(str(tmp_path / "r"))
    rows, watch = counted(spark.read.parquet(str(tmp_path / "r")), F.col("Reason").isNotNull())
    assert plan(rows).count("FileScan") == 1
    rows.filter("Reason is not null").write.parquet(str(tmp_path / "w"))
    assert watch.get == {"n_read": 10, "n_kept": 8, "n_rejected": 2}
    audits = Audits(spark, str(tmp_path / "a"))
    assert audits.latest().count() == 0
    audits.record("x", "d", watch.get)
    audits.record("x", "d", {"n_read": 3, "n_kept": 3, "n_rejected": 0})
    assert [tuple(r) for r in audits.latest().collect()] == [("x", "d", 3, 3, 0)]
    with pytest.raises(RuntimeError, match="read 3 rows"):
        audits.record("x", "d", {"n_read": 3, "n_kept": 1, "n_rejected": 1})


def test_a_list_of_dates_prunes_the_scan(spark, tmp_path, plan):
    path, dates = str(tmp_path / "e"), str(tmp_path / "d")
    spark.range(100).selectExpr("id", "concat('d', id % 10) as day").write.partitionBy("day").parquet(path)
    spark.range(10).selectExpr("concat('d', id) as day", "id in (2, 7) as due").write.parquet(dates)
    due = spark.read.parquet(dates).filter("due")
    found = batches_of(spark.read.parquet(path), due, "day")
    assert "dynamicpruning" in plan(found).lower()
    assert sorted({r.day for r in found.collect()}) == ["d2", "d7"] and found.count() == 20
