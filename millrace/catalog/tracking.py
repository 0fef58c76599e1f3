"""Batches, new files and small drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import query, read
from millrace.operators import incremental


@query("""
    select event_id, user_id, event_type, value from events
    where cast(ts as date) = date '2024-01-15'
""")
def batch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incremental.batch_of(read(spark, sf_dir, "events"), "2024-01-15", "ts")
    return rows.select("event_id", "user_id", "event_type", "value")


@query("""
    select distinct o_orderkey as drop_id from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def new_files_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listed drops, line items as the rows landed from them."""
    listed = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("drop_id"))
    landed = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("drop_id"))
    return incremental.unseen(listed, landed, ["drop_id"])


@query("""
    select distinct cast(ts as date) as batch_date from events
    except
    select distinct cast(ts as date) from events where ts < timestamp '2024-01-20 00:00:00'
""")
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event dates against a ledger that ends on January 19th."""
    ts = F.col("ts")
    batches = read(spark, sf_dir, "events").select("ts", ts.cast("date").alias("batch_date"))
    done = batches.filter(ts < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return incremental.pending_batches(batches, done, ["batch_date"])


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
    where l_orderkey in (select l_orderkey from lineitem group by l_orderkey having count(*) >= 2)
""")
def min_rows_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as drops; those of a single line are skipped."""
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return incremental.min_rows_guard(rows, ["l_orderkey"], min_rows=2)
