from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_by_key, dedup_rows, distinct_keys

SCHEMA = "k1 string, k2 string, name string, age int"
ROWS = [
    ("1015", "C077", "Brown", 16),
    ("1015", "C077", "White", 20),
    ("1016", "C077", None, 15),
    ("1016", "C077", "Green", None),
    (None, "C078", "A", 1),
    (None, "C078", "B", 2),
]


def test_survivor_does_not_depend_on_input_order(spark, rows):
    expected = None
    for order in (ROWS, ROWS[::-1], ROWS[3:] + ROWS[:3]):
        df = spark.createDataFrame(order, SCHEMA).repartition(3, F.rand(1))
        got = rows(dedup_by_key(df, ["k1", "k2"]))
        expected = expected or got
        assert got == expected
    # Ties go by the other columns, ascending with nulls last; null keys are one key.
    assert expected == sorted(
        [("1015", "C077", "Brown", 16), ("1016", "C077", "Green", None), (None, "C078", "A", 1)],
        key=repr,
    )


def test_order_by_comes_before_ties(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = dedup_by_key(df, ["k1", "k2"], [F.col("age").desc_nulls_last()])
    assert {r.k1: r.name for r in got.collect()} == {"1015": "White", "1016": None, None: "B"}


def test_key_columns_only(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup_by_key(df, ["k"])) == [(1,), (2,)]


def test_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    text = plan(dedup_by_key(df, ["k"]))
    below_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
    assert dedup_by_key(df, ["k"]).count() == 200_001


def test_whole_rows_and_key_projection(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "k int, v string")
    assert rows(dedup_rows(df)) == rows(spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], df.schema))
    assert rows(distinct_keys(df, ["k"])) == [(1,), (None,)]
