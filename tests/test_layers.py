import os

import pytest

from millrace.plans import lms
from millrace.plans.refine import Layers, bronze, ingest, pending, rejects_of
from tests.lms_rows import csv_text, row

DAY1, DAY2 = "2024-01-15", "2024-01-16"


@pytest.fixture
def drops(tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()

    def write(name, *rows, modified=1_700_000_000):
        path = folder / name
        path.write_text(csv_text(*rows))
        os.utime(path, (modified, modified))
        return str(path)

    write.folder = str(folder)
    return write


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "tables"))


def land(spark, layers, drops, day=DAY1, **options):
    return ingest(spark, drops.folder, layers.landing, day, **options)


def fact(layers):
    return {(r.Student_ID, r.Course_ID): r for r in layers.fact.read().collect()}


def test_two_days_end_to_end(spark, layers, drops):
    drops("a.csv", row("1001"), row("1002", Completion_Date="11/1/2023"), row("1003"))
    drops("b.csv", row("1003", Name="Newer File", Age=20), modified=1_700_000_100)
    drops("empty.csv")
    drops("notes.txt", row("9999"))
    assert land(spark, layers, drops) == 3
    layers.refresh(DAY1)

    assert layers.landing.read().count() == 4
    assert layers.bronze.read().count() == layers.silver.read().count() == layers.fact.read().count() == 3
    got = fact(layers)
    assert got["1001", "C071"].Performance_Score == 43.85
    assert got["1001", "C071"].Course_Completion_Rate == "Delayed"
    assert got["1002", "C071"].Course_Completion_Rate == "On-Time"
    students = {r.Student_ID: r for r in layers.star["dim_student"].read().collect()}
    assert students["1003"].Name == "Newer File" and students["1003"].Age == 20
    assert [tuple(r) for r in layers.star["dim_course"].read().collect()] == [
        ("C071", "Introduction to Music", "9")
    ]

    # Next day: a correction with a gap, a new enrolment, and a row that fails.
    drops(
        "c.csv",
        row("1001", Final_Grade="A+", Gender=None, Status=None),
        row("1004", "C072", Course_Name="Art"),
        row("1005", Completion_Date="1/1/2020"),
        row(None),
    )
    land(spark, layers, drops, DAY2)
    layers.refresh(DAY2)
    got = fact(layers)
    assert set(got) == {("1001", "C071"), ("1002", "C071"), ("1003", "C071"), ("1004", "C072")}
    corrected = got["1001", "C071"]
    assert corrected.Final_Grade == "A+"
    assert corrected.Status == "Completed"  # a gap keeps the stored value
    assert str(corrected.Processing_Date) == DAY1  # first seen
    assert str(got["1004", "C072"].Processing_Date) == DAY2
    stored = {r.Student_ID: r for r in layers.bronze.read().collect()}
    assert (stored["1001"].Processing_Date, stored["1001"].Last_Batch_Date) == (DAY1, DAY2)
    assert stored["1002"].Last_Batch_Date == DAY1
    assert layers.star["dim_student"].read().filter("Student_ID = '1001'").first().Gender == "M"
    assert [(r.Student_ID, r.Stage, r.Processing_Date) for r in layers.bronze_rejects.read().collect()] \
        == [(None, "bronze", DAY2)]
    assert [(r.Student_ID, r.Stage) for r in layers.silver_rejects.read().collect()] == [("1005", "silver")]
    assert layers.fact.read().schema.names == lms.FACT.schema.names


def snapshot_rows(layers, rows):
    tables = [layers.bronze, layers.silver, layers.silver_rejects, *layers.star.values()]
    return [rows(t.read()) for t in tables]


def test_running_a_batch_again_changes_nothing(spark, layers, drops, rows):
    drops("a.csv", row("1"), row("2", Completion_Date="1/1/2020"), row("3", "C2"))
    land(spark, layers, drops)
    layers.refresh(DAY1)
    before = snapshot_rows(layers, rows)
    layers.refresh(DAY1)
    assert snapshot_rows(layers, rows) == before


def test_a_file_lands_once_and_late_files_are_picked_up(spark, layers, drops, rows):
    drops("a.csv", row("1"))
    assert land(spark, layers, drops) == 1
    assert land(spark, layers, drops) == 0
    layers.refresh_pending()
    assert pending(layers.landing, layers.bronze) == pending(layers.silver, layers.fact) == []
    drops("late.csv", row("2"))
    assert land(spark, layers, drops) == 1  # same date, after the day was processed
    assert pending(layers.landing, layers.bronze) == [DAY1]
    layers.refresh_pending()
    assert {k[0] for k in fact(layers)} == {"1", "2"}
    assert pending(layers.landing, layers.bronze) == pending(layers.silver, layers.fact) == []


def test_order_of_drops_does_not_matter(spark, tmp_path, drops, rows):
    first = drops("a.csv", row("1", Name="Old"), row("2", Name="A"))
    second = drops("b.csv", row("1", Name="New"), row("2", Name="B"), modified=1_700_000_100)
    results = []
    for n, paths in enumerate(([first, second], [second, first])):
        layers = Layers(spark, str(tmp_path / f"t{n}"))
        for path in paths:
            ingest(spark, [path], layers.landing, DAY1)
        layers.refresh_pending()
        results.append(snapshot_rows(layers, rows))
    assert results[0] == results[1]
    assert {r[1] for r in results[0][-3]} == {"New", "B"}


def test_drops_without_rows_leave_no_batch_behind(spark, layers, drops):
    drops("empty.csv")
    land(spark, layers, drops)
    assert pending(layers.landing, layers.bronze) == []
    drops("a.csv", row("1"))
    land(spark, layers, drops)
    layers.refresh_pending()
    land(spark, layers, drops)
    assert pending(layers.landing, layers.bronze) == []
    assert layers.fact.read().count() == 1


def test_odd_file_names(spark, layers, drops):
    names = ["a b.csv", "c%20d.csv", "e[1].csv", "g{x}.csv", "h*i.csv", "hi.csv", "ü.csv"]
    for n, name in enumerate(names):
        drops(name, row(str(n)))
    assert land(spark, layers, drops) == len(names)
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == list("0123456")
    assert land(spark, layers, drops) == 0


def test_small_files(spark, tmp_path, drops):
    drops("none.csv")
    drops("one.csv", row("1"))
    drops("two.csv", row("2"), row("3"))
    kept = {}
    for min_rows in (1, 2):
        layers = Layers(spark, str(tmp_path / f"t{min_rows}"))
        land(spark, layers, drops, min_rows=min_rows)
        kept[min_rows] = {r.Student_ID for r in layers.landing.read().collect()}
    assert kept == {1: {"1", "2", "3"}, 2: {"2", "3"}}


def test_one_row_per_dimension_key(spark, layers, drops):
    drops(
        "a.csv",
        row("1", "C1", Course_Name="Old Name", Age=15),
        row("1", "C2", Age=16, Enrollment_Date="9/5/2023"),
        row("2", "C1", Course_Name="New Name", Enrollment_Date="9/9/2023"),
    )
    land(spark, layers, drops)
    layers.refresh(DAY1)
    students = layers.star["dim_student"].read().collect()
    courses = {r.Course_ID: r.Course_Name for r in layers.star["dim_course"].read().collect()}
    assert sorted((r.Student_ID, r.Age) for r in students) == [("1", 16), ("2", 16)]
    assert courses == {"C1": "New Name", "C2": "Introduction to Music"}
    assert layers.fact.read().count() == 3
    layers.refresh(DAY1)
    assert layers.star["dim_student"].read().count() == 2


def test_a_failing_step_raises_and_stays_pending(spark, layers, drops, monkeypatch):
    drops("a.csv", row("1"))
    land(spark, layers, drops)

    def broken(*args, **kwargs):
        raise RuntimeError("lost the cluster")

    with monkeypatch.context() as patched:
        patched.setattr(layers.bronze, "_write", broken)
        with pytest.raises(RuntimeError, match="lost the cluster"):
            bronze(layers.landing, layers.bronze, layers.bronze_rejects, DAY1)
    assert pending(layers.landing, layers.bronze) == [DAY1]
    layers.refresh_pending()
    assert layers.fact.read().count() == 1


def test_malformed_numbers_become_null_then_default(spark, layers, drops):
    drops("a.csv", row("1", Age="sixteen", Quiz_Average_Score="n/a"))
    land(spark, layers, drops)
    layers.refresh(DAY1)
    silver = layers.silver.read().first()
    assert (silver.Age, silver.Quiz_Average_Score, silver.Performance_Score) == (0, 0.0, 26.25)


def test_rows_before_the_first_batch(layers):
    assert pending(layers.landing, layers.bronze) == []
    layers.refresh(DAY1)
    assert layers.fact.read().count() == 0


def test_late_file_fills_gaps_and_reverts_nothing(spark, layers, drops, rows):
    drops("a.csv", row("1", Final_Grade="C", Name="Old"), row("2"))
    land(spark, layers, drops)
    layers.refresh_pending()
    drops("b.csv", row("1", Final_Grade="A", Name="New", Grade_Level=None), row("4", Course_Name=None))
    land(spark, layers, drops, DAY2)
    layers.refresh_pending()
    drops("late.csv", row("1", "C9", Name="Late", Enrollment_Date="9/9/2023"), row("3"), row("4", Course_Name="Filled", Final_Grade="F"))
    land(spark, layers, drops, DAY1)
    layers.refresh_pending()
    got = fact(layers)
    assert set(got) == {("1", "C071"), ("1", "C9"), ("2", "C071"), ("3", "C071"), ("4", "C071")}
    assert got["1", "C071"].Final_Grade == "A"
    assert got["4", "C071"].Final_Grade == "A-"
    stored = {(r.Student_ID, r.Course_ID): r for r in layers.silver.read().collect()}
    assert stored["4", "C071"].Course_Name == "Filled"  # the gap travelled
    assert (stored["1", "C071"].Newest_Batch_Date, stored["1", "C071"].Last_Batch_Date) == (DAY2, DAY2)
    assert (stored["4", "C071"].Newest_Batch_Date, stored["4", "C071"].Last_Batch_Date) == (DAY2, DAY1)
    names = {r.Student_ID: r.Name for r in layers.star["dim_student"].read().collect()}
    assert names["1"] == "New"
    before = snapshot_rows(layers, rows)
    for day in (DAY2, DAY1, DAY2):
        layers.refresh(day)
    assert snapshot_rows(layers, rows) == before


def test_malformed_lines_keep_their_text(spark, layers, drops):
    path = drops("a.csv", row("1", Age="sixteen"), row("2"))
    with open(path, "a") as file:
        file.write("3,short line\r\n")
    land(spark, layers, drops)
    assert layers.landing.read().count() == 3
    got = {r.Line.split(",")[0]: r for r in rejects_of(layers.landing).read().collect()}
    assert set(got) == {"1", "3"}
    assert ",sixteen," in got["1"].Line and got["1"].Source_File.endswith("a.csv")


def test_columns_bind_by_header_name(spark, layers, drops):
    path = drops("a.csv", row("1", Name="Ann"))
    with open(path) as file:
        text = file.read().replace("Student_ID,Name", "name, Student_ID ").replace("1,Ann", "Ann,1")
    with open(path, "w") as file:
        file.write(text)
    assert land(spark, layers, drops) == 1
    assert [(r.Student_ID, r.Name) for r in layers.landing.read().collect()] == [("1", "Ann")]


def test_without_a_look_at_the_header_columns_bind_by_position(spark, layers, drops):
    path = drops("a.csv", row("1", Name="Ann"))
    with open(path) as file:
        text = file.read().replace("Student_ID,Name", "Name,Student_ID")
    with open(path, "w") as file:
        file.write(text)
    assert land(spark, layers, drops, check_header=False) == 1
    assert [(r.Student_ID, r.Name) for r in layers.landing.read().collect()] == [("1", "Ann")]
