"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, queries
from millrace.catalog import ORACLES, QUERIES, layers
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    assert entry(spark).columns == [
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_tax",
        "start_date", "end_date", "days", "score", "label",
    ]


def test_drops_broadcast_no_table_that_is_small_in_its_files_alone(spark, tmp_path, plan, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="300k")
    n = spark.range(20_000)
    tables = {
        "customer": n.selectExpr("id as c_custkey", "'the same name' as c_name", "'BUILDING' as c_mktsegment"),
        "part": n.selectExpr("id as p_partkey", "'the same name' as p_name", "1 as p_size"),
        "orders": n.selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "date'1998-05-01' as o_orderdate", "rand(1) as o_totalprice"),
        "lineitem": n.selectExpr("id as l_orderkey", "id as l_partkey", "1 as l_linenumber", "rand(2) as l_quantity", "rand(3) as l_extendedprice",
                                 "rand(4) as l_tax", "'N' as l_returnflag", "date'1998-06-01' as l_shipdate"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    drops = {0: F.col("o_orderdate") < F.lit("1999-01-01").cast("date"), 1: F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")}
    rows = layers._drop_rows(spark, str(tmp_path), drops)
    assert "BroadcastHashJoin" not in plan(rows)
    assert rows.groupBy("drop").count().orderBy("drop").collect() == [(0, 20_000), (1, 20_000)]
