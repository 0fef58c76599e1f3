"""Drops written by Spark and read back, and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.merging import KEYS, UPSERTED, later, orders, stored
from millrace.catalog.registry import query, read
from millrace.operators.incremental import batch_of
from millrace.plans.specs import schema_of
from millrace.session import scratch_path
from millrace.sources import csv
from millrace.sources.tables import Origin, Table


def _text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as drop text, the price unreadable where the priority is open."""
    price = F.when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("n/a")
    ).otherwise(F.col("o_totalprice").cast("string"))
    return orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", price.alias("o_totalprice"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"),
    )


def _written(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path


@query("""
    select cast(o_orderkey as integer) as o_orderkey, cast(o_custkey as integer) as o_custkey,
           o_totalprice, o_orderpriority,
           concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) as o_orderdate
    from orders
""")
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers are recognised, M/d/yyyy dates stay text."""
    rows = orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"),
    )
    return csv.scan_inferred(spark, _written(rows, "csv_scan_inferred"))


# Names differ from the header on purpose: columns bind by position.
_POSITIONAL = schema_of("key bigint, cust bigint, price double, day string")


@query("""
    select o_orderkey as key, o_custkey as cust,
           case when o_orderpriority <> '4-NOT SPECIFIED' then o_totalprice end as price,
           concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) as day
    from orders
""")
def csv_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared schema by position; unreadable numbers become null."""
    path = _written(_text_orders(spark, sf_dir), "csv_scan_schema")
    return csv.scan(spark, path, _POSITIONAL)


@query("""
    select o_orderkey as key,
           concat(o_orderkey, ',', o_custkey, ',n/a,',
                  month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) as line
    from orders where o_orderpriority = '4-NOT SPECIFIED'
""")
def csv_scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the lines that did not fit the schema."""
    path = _written(_text_orders(spark, sf_dir), "csv_scan_rejects")
    landed = scratch_path(spark, "csv_scan_rejects_landed")
    csv.scan(spark, path, _POSITIONAL, keep_corrupt=True).write.parquet(landed)
    rows = spark.read.parquet(landed)
    return rows.filter(F.col(csv.CORRUPT).isNotNull()).select(
        "key", F.col(csv.CORRUPT).alias("line")
    )


_EVENTS = schema_of(
    "event_id bigint, user_id bigint, event_type string, value double, batch_date string"
)


@query("""
    select event_id, user_id, event_type, value, cast(cast(ts as date) as varchar) as batch_date
    from events where cast(ts as date) = date '2024-01-15'
""")
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events stored by date, one date read back through its partition."""
    table = Table(spark, scratch_path(spark, "partition_scan"), _EVENTS, "batch_date")
    day = F.date_format("ts", "yyyy-MM-dd").alias("batch_date")
    table.append(read(spark, sf_dir, "events").select("*", day), balance=True)
    return batch_of(table.read(), "2024-01-15", "batch_date")


@query("""
    select event_id, user_id, event_type,
           case when cast(ts as date) = date '2024-01-15' then value + 1 else value end as value,
           cast(cast(ts as date) as varchar) as batch_date
    from events
""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events stored by date; one date delivered again, twice, replaces its partition."""
    table = Table(spark, scratch_path(spark, "partition_overwrite"), _EVENTS, "batch_date")
    day = F.date_format("ts", "yyyy-MM-dd").alias("batch_date")
    events = read(spark, sf_dir, "events").select("*", day)
    again = batch_of(events, "2024-01-15", "ts").withColumn("value", F.col("value") + 1)
    table.append(events, balance=True)
    for _ in range(2):
        table.overwrite(again)
    return table.read()


@query("""
    select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
""")
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is not there is created empty, once, and takes a first load."""
    rows = read(spark, sf_dir, "customer")
    table = Table(spark, scratch_path(spark, "create_if_absent"), rows.schema)
    before = table.read()
    for _ in range(2):
        if not table.exists():
            table.create()
    table.append(rows)
    return before.unionByName(table.read())


@query(f"""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           case when o_orderdate < date '1999-01-01' then '1998-12-31' else '2001-08-01' end
               as batch_date
    from ({UPSERTED})
""")
def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of orders merged into a stored table, one version each."""
    def dated(df: DataFrame, day: str) -> DataFrame:
        return df.withColumn("batch_date", F.lit(day))

    first = dated(stored(spark, sf_dir), "1998-12-31")
    table = Table(spark, scratch_path(spark, "table_upsert"), first.schema, "batch_date")
    table.append(first, Origin(batch="1998-12-31"))
    incoming = dated(later(spark, sf_dir), "2001-08-01")
    table.merge(incoming, KEYS, ["batch_date"], origin=Origin(batch="2001-08-01"))
    return table.read()
