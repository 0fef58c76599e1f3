import datetime as dt

import pytest

from millrace.plans import star
from millrace.plans.specs import TableSpec, schema_of

DIM = TableSpec("dim", ("k",), schema_of("k string, name string"), newest_by=("day",))
WIDE = schema_of("k string, other int, name string, day date")


@pytest.fixture
def wide(spark):
    day = dt.date
    return spark.createDataFrame(
        [("a", 1, "old", day(2024, 1, 1)), ("a", 2, "new", day(2024, 1, 2)),
         ("b", 1, None, day(2024, 1, 1)), ("c", 1, "z", None), ("c", 2, "y", None)],
        WIDE,
    )


def test_rows_come_down_to_the_grain_of_the_table(wide, rows):
    assert rows(star.rows_for(wide, DIM)) == sorted([("a", "new"), ("b", None), ("c", "y")], key=repr)


def test_build_keeps_other_rows_and_fills_gaps_from_the_stored_one(spark, wide, rows):
    stored = spark.createDataFrame([("a", "first"), ("b", "kept"), ("x", "kept")], DIM.schema)
    for strategy in ("auto", "patch", "full_outer"):
        assert rows(star.build(stored, wide, DIM, strategy)) == [
            ("a", "new"), ("b", "kept"), ("c", "y"), ("x", "kept")
        ]


def test_rows_unique_on_the_keys_are_not_shuffled(wide, plan):
    assert "Exchange" in plan(star.rows_for(wide, DIM, unique_on=("k", "other")))
    assert "Exchange" not in plan(star.rows_for(wide, DIM, unique_on=("k",)))
