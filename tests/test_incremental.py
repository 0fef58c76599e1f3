import datetime as dt

from pyspark.sql import functions as F

from millrace.operators.incremental import batch_of, min_rows_guard, pending_batches, stamp_batch, unseen


def test_batch_of_any_kind_of_date_column(spark):
    for kind in ("string", "date", "timestamp", "timestamp_ntz"):
        texts = ["2024-01-14 23:59:59", "2024-01-15 00:00:00", "2024-01-15 23:59:59", "2024-01-16 00:00:00"]
        if kind in ("string", "date"):
            texts = [t[:10] for t in texts]
        df = spark.createDataFrame([(t,) for t in texts], "d string").select(F.col("d").cast(kind))
        assert batch_of(df, "2024-01-15", "d").count() == 2
        assert batch_of(df, dt.date(2024, 1, 15), "d").count() == 2


def test_stamp_then_select(spark):
    df = stamp_batch(spark.range(3), "2024-01-15")
    assert batch_of(df, "2024-01-15").count() == 3
    assert batch_of(df, "2024-01-16").count() == 0


def test_batch_filter_on_time_reaches_the_scan(spark, plan):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(batch_of(events, "2024-01-15", "ts").select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text and "LessThan(ts,2024-01-16T00:00)" in text


def test_unseen_names_each_new_key_once(spark, rows):
    listing = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "path string")
    seen = spark.createDataFrame([("a",)] * 3 + [("z",)], "path string")
    assert rows(unseen(listing, seen, ["path"])) == [("b",), ("c",)]
    assert rows(pending_batches(listing, listing, ["path"])) == []


def test_min_rows_guard(spark, rows):
    df = spark.createDataFrame([("f1", 1), ("f2", 1), ("f2", 2), (None, 1)], "file string, v int")
    assert min_rows_guard(df, ["file"]) is df
    assert rows(min_rows_guard(df, ["file"], 2)) == [("f2", 1), ("f2", 2)]
    assert rows(min_rows_guard(df, ["file"], 3)) == []
