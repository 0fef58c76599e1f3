"""Where queries register themselves, and the inputs several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.specs import ConformSpec
from millrace.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must agree with it."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[run.__name__] = tuned
        ORACLES[run.__name__] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# An enrolment row: a line item with its order.  The order side is unique on
# its key; line items of one heavy order are split at run time by Spark's
# skew-join handling.

ENROLMENTS = """
    select l_orderkey, l_linenumber, l_partkey, o_custkey, l_quantity, l_extendedprice, l_tax,
           l_returnflag, l_linestatus, o_orderstatus, o_orderpriority,
           cast(o_orderdate as date) as o_orderdate, cast(l_shipdate as date) as l_shipdate
    from lineitem join orders on l_orderkey = o_orderkey
"""


def enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey",
        "l_quantity", "l_extendedprice", "l_tax",
        "l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )


# The metrics of an enrolment.  Scores are computed in decimals, so that both
# engines round the same exact value.

SPEC = ConformSpec(
    critical=("l_orderkey", "l_linenumber", "o_orderdate"),
    defaults={"l_linestatus": "Unknown", "l_tax": 0.0, "l_shipdate": "12/31/9999"},
    start="o_orderdate",
    end="l_shipdate",
    date_format="M/d/yyyy",
    days="days",
    score="score",
    weights={"l_quantity": "0.2", "l_extendedprice": "0.2", "l_tax": "0.1"},
    label="label",
    label_limit=90,
    label_within="On-Time",
    label_beyond="Delayed",
    exact_score=T.DecimalType(18, 2),
)

DAYS = "cast(date_diff('day', o_orderdate, l_shipdate) as integer)"
SCORE = """cast(round(cast(l_quantity as decimal(18, 2)) * 0.2
                    + cast(l_extendedprice as decimal(18, 2)) * 0.2
                    + cast(l_tax as decimal(18, 2)) * 0.1, 2) as double)"""
LABEL = f"case when {DAYS} <= 90 then 'On-Time' else 'Delayed' end"
