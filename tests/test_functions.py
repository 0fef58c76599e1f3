import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("9/1/2023", dt.date(2023, 9, 1)),
        ("09/01/2023", dt.date(2023, 9, 1)),
        ("12/31/9999", dt.date(9999, 12, 31)),
        ("13/45/2020", None),
        ("2/30/2024", None),
        ("2023-09-01", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date_never_raises(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(fn.parse_date("d")).first()[0] == day


def test_days_between(spark):
    df = spark.createDataFrame(
        [(dt.date(2023, 9, 1), dt.date(2023, 12, 15)), (dt.date(2024, 1, 1), None)],
        "a date, b date",
    ).select(fn.days_between("a", "b").alias("n"))
    assert [r.n for r in df.collect()] == [105, None]
    assert df.schema["n"].dataType == T.IntegerType()


WEIGHTS = {"quiz": "0.2", "assignment": "0.2", "project": "0.1"}


def test_weighted_score(spark):
    values = {"quiz": 88.0, "assignment": 88.75, "project": 85.0}
    assert one(spark, fn.weighted_score(WEIGHTS), **values) == 43.85
    assert one(spark, fn.weighted_score(WEIGHTS, via=T.DecimalType(18, 2)), **values) == 43.85
    # 0.335 exactly: decimals round the half up.
    half = {"quiz": 1.0, "assignment": 0.67, "project": 0.01}
    assert one(spark, fn.weighted_score(WEIGHTS, via=T.DecimalType(18, 2)), **half) == 0.34
    half["assignment"] = 0.63
    half["project"] = 0.19
    assert one(spark, fn.weighted_score(WEIGHTS, via=T.DecimalType(18, 2)), **half) == 0.35


def test_weighted_score_of_a_null_is_null(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "quiz double, assignment double, project double")
    assert df.select(fn.weighted_score(WEIGHTS)).first()[0] is None


@pytest.mark.parametrize(("days", "label"), [(89, "On-Time"), (90, "On-Time"), (91, "Delayed"), (None, "Delayed")])
def test_threshold_label(spark, days, label):
    df = spark.createDataFrame([(days,)], "days int")
    assert df.select(fn.threshold_label("days", 90, "On-Time", "Delayed")).first()[0] == label


def test_stamp(spark):
    assert one(spark, fn.stamp("2024-01-15")) == one(spark, fn.stamp(dt.date(2024, 1, 15))) == "2024-01-15"
    with pytest.raises(ValueError):
        fn.stamp("15.1.2024")
