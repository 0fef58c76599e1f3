import datetime as dt

import pytest

from millrace.plans import conform, lms
from tests.lms_rows import frame, row


def conformed(spark, *rows):
    return [r.asDict() for r in conform.conform(frame(spark, *rows), lms.CONFORM).collect()]


def test_metrics_of_a_known_row(spark):
    (got,) = conformed(spark, row())
    assert got["Enrollment_Date"] == dt.date(2023, 9, 1)
    assert got["Completion_Date"] == dt.date(2023, 12, 15)
    assert (got["Completion_Time_Days"], got["Performance_Score"]) == (105, 43.85)
    assert got["Course_Completion_Rate"] == "Delayed"
    assert got["Assignment_Scores"] == "[85, 90, 88, 92]"


@pytest.mark.parametrize(
    ("end", "label"), [("11/30/2023", "On-Time"), ("12/1/2023", "Delayed"), ("9/1/2023", "On-Time")]
)
def test_label_turns_after_day_90(spark, end, label):
    assert conformed(spark, row(Completion_Date=end))[0]["Course_Completion_Rate"] == label


def test_every_default(spark):
    empty = {c: None for c in (*lms.DEFAULTS, "Name", "Grade_Level", "Course_Name", "Assignment_Scores")}
    (got,) = conformed(spark, row(**empty))
    replaced = {
        "Completion_Date": dt.date(9999, 12, 31),
        "Completion_Time_Days": (dt.date(9999, 12, 31) - dt.date(2023, 9, 1)).days,
        "Performance_Score": 0.0,
        "Course_Completion_Rate": "Delayed",
    }
    for column, default in (lms.DEFAULTS | replaced).items():
        assert got[column] == default, column
    # These have no default.
    assert [got[c] for c in ("Name", "Grade_Level", "Course_Name", "Assignment_Scores")] == [None] * 4


def test_every_input_row_is_kept_or_rejected_once(spark):
    data = [
        row("1"),
        row("2", Completion_Date=None),
        row(None),
        row("4", None),
        row("5", Enrollment_Date=None),
        row("6", Enrollment_Date="2023-09-01"),
        row("7", Completion_Date="soon"),
        row("8", Completion_Date="8/31/2023"),
        row("9", Completion_Date="9/1/2023"),
    ]
    df = frame(spark, *data, data[0])
    counts = conform.audit(df, lms.CONFORM).first().asDict()
    assert counts == {"n_rows": 10, "n_kept": 4, "n_missing": 3, "n_inconsistent": 3}
    kept = {r.Student_ID for r in conform.conform(df, lms.CONFORM).collect()}
    rejected = {(r.Student_ID, r.Reason) for r in conform.rejects(df, lms.CONFORM).collect()}
    assert kept == {"1", "2", "9"}
    assert rejected == {
        (None, conform.MISSING), ("4", conform.MISSING), ("5", conform.MISSING),
        ("6", conform.INCONSISTENT), ("7", conform.INCONSISTENT), ("8", conform.INCONSISTENT),
    }


def test_exact_duplicates_count_once_and_differing_rows_stay(spark):
    assert len(conformed(spark, row(), row(), row(Age=17))) == 2


def test_schema_fits_the_silver_table(spark):
    got = conform.conform(frame(spark, row()), lms.CONFORM)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in lms.SILVER}


def test_conform_is_one_narrow_pass(spark, plan):
    # The whole-row duplicate removal is the only shuffle.
    df = frame(spark, row())
    assert plan(conform.conform(df, lms.CONFORM)).count("Exchange") == 1
    assert plan(conform.conform(df, lms.CONFORM, unique=True)).count("Exchange") == 0
