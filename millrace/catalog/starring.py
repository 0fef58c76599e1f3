"""Dimension and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.refining import CONFORMED, conformed_enrolments
from millrace.catalog.registry import query, read
from millrace.operators.dedup import dedup_by_key
from millrace.plans import star
from millrace.plans.specs import TableSpec, schema_of

CUSTOMER = TableSpec(
    name="dim_customer",
    keys=("c_custkey",),
    schema=schema_of(
        "c_custkey bigint, c_name string, c_mktsegment string, latest_priority string"
    ),
    newest_by=("o_orderdate",),
)

PART = TableSpec(
    name="dim_part",
    keys=("p_partkey",),
    schema=schema_of("p_partkey bigint, p_name string, p_brand string"),
    newest_by=("l_shipdate",),
)

FACT = TableSpec(
    name="fact_enrolment",
    keys=("l_orderkey", "l_linenumber"),
    schema=schema_of("""
        l_orderkey bigint, l_linenumber int, l_partkey bigint, l_linestatus string,
        days int, score double, label string, processing_date string
    """),
    first_wins=("processing_date",),
)


@query("""
    with incoming as (
        select c_custkey, c_name, c_mktsegment,
               nullif(o_orderpriority, '4-NOT SPECIFIED') as latest_priority,
               row_number() over (
                   partition by c_custkey
                   order by o_orderdate desc nulls last,
                            nullif(o_orderpriority, '4-NOT SPECIFIED') nulls last) as rn
        from orders join customer on o_custkey = c_custkey),
    stored as (
        select c_custkey, c_name, 'UNKNOWN' as c_mktsegment, '9-NONE' as latest_priority
        from customer)
    select coalesce(n.c_custkey, b.c_custkey) as c_custkey, coalesce(n.c_name, b.c_name) as c_name,
           coalesce(n.c_mktsegment, b.c_mktsegment) as c_mktsegment,
           coalesce(n.latest_priority, b.latest_priority) as latest_priority
    from stored b full join (select * from incoming where rn = 1) n on b.c_custkey = n.c_custkey
""")
def dim_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from order rows: many rows per customer, merged into all customers.

    The newest order of each customer is picked before the join, so a customer
    with a large share of the orders brings one row to it.
    """
    customer = read(spark, sf_dir, "customer")
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("latest_priority"),
    )
    newest = dedup_by_key(orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last()])
    facts = newest.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    stored = customer.select(
        "c_custkey", "c_name",
        F.lit("UNKNOWN").alias("c_mktsegment"), F.lit("9-NONE").alias("latest_priority"),
    )
    return star.build(stored, facts, CUSTOMER, unique_on=CUSTOMER.keys)


@query("""
    select p_partkey, p_name, p_brand from part
    where exists (select 1 from lineitem where l_partkey = p_partkey)
""")
def dim_build_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts from line-item rows, into a dimension that does not exist yet."""
    newest = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.max("l_shipdate").alias("l_shipdate")
    )
    facts = newest.join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    stored = spark.createDataFrame([], PART.schema)
    return star.build(stored, facts, PART, unique_on=PART.keys)


_FACT_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_linestatus, days, score, label"


@query(f"""
    with conformed as ({CONFORMED}),
    stored as (select {_FACT_COLUMNS}, '1998-12-31' as processing_date
               from conformed where o_orderdate < date '1999-01-01'),
    incoming as (select {_FACT_COLUMNS}, '2001-08-01' as processing_date
                 from conformed where o_orderdate >= date '1998-01-01')
    select coalesce(n.l_orderkey, b.l_orderkey) as l_orderkey,
           coalesce(n.l_linenumber, b.l_linenumber) as l_linenumber,
           coalesce(n.l_partkey, b.l_partkey) as l_partkey,
           coalesce(n.l_linestatus, b.l_linestatus) as l_linestatus,
           coalesce(n.days, b.days) as days, coalesce(n.score, b.score) as score,
           coalesce(n.label, b.label) as label,
           coalesce(b.processing_date, n.processing_date) as processing_date
    from stored b full join incoming n
    on b.l_orderkey = n.l_orderkey and b.l_linenumber = n.l_linenumber
""")
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed enrolments of a later delivery, merged into those stored before."""
    rows = conformed_enrolments(spark, sf_dir)
    day = F.col("o_orderdate")
    stored = rows.filter(day < F.lit("1999-01-01").cast("date"))
    incoming = rows.filter(day >= F.lit("1998-01-01").cast("date"))
    stored = stored.withColumn("processing_date", F.lit("1998-12-31"))
    incoming = incoming.withColumn("processing_date", F.lit("2001-08-01"))
    return star.build(
        stored.select(*FACT.schema.names), incoming, FACT, unique_on=FACT.keys
    )
