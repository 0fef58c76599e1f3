"""One key with a third of all rows: plans split it or reduce it first."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_by_key
from millrace.operators.incremental import min_rows_guard, unseen
from millrace.plans.specs import schema_of
from millrace.sources.tables import Table

N = 400_000


@pytest.fixture
def facts(spark, tmp_path):
    path = str(tmp_path / "facts")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint")
    spark.range(N).select(hot.alias("k"), F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("pad")) \
        .repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_limits(settings):
    """Skew limits scaled down to the size of the fixture; no broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1m",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2m",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
    )


def final_plan(df, plan):
    """The plan as it was after running, with the splits made at run time."""
    df.collect()
    return plan(df)


def test_lookup_join_is_split(spark, facts, small_limits, plan):
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    joined = facts.join(lookup, "k").select("k", "n", "v", "pad")
    assert "skew=true" in final_plan(joined, plan)
    assert joined.count() == N


def test_join_under_a_key_operator_is_split_too(spark, facts, small_limits, plan):
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    newest = dedup_by_key(facts.join(lookup, "k"), ["k", "n"])
    assert "skew=true" in final_plan(newest, plan)
    assert newest.count() == N


def test_small_group_guard_is_split(facts, small_limits, plan, spark):
    single = spark.range(3).select((-F.col("id") - 1).alias("k"), F.col("id").alias("n"), F.lit("x").alias("pad"))
    kept = min_rows_guard(facts.unionByName(single), ["k"], 2)
    assert "skew=true" in final_plan(kept, plan)
    assert kept.count() == N


def test_dedup_and_unseen_shuffle_one_row_per_task_and_key(facts, spark, settings, plan):
    settings(spark__sql__adaptive__enabled="false")
    assert dedup_by_key(facts, ["k"]).count() == 5000
    listing = spark.range(4990, 5010).select(F.col("id").alias("k"))
    text = plan(unseen(listing, facts, ["k"]))
    assert "HashAggregate" in text[text.rindex("Exchange hashpartitioning"):]
    assert {r.k for r in unseen(listing, facts, ["k"]).collect()} == set(range(5000, 5010))


@pytest.mark.parametrize("strategy", ["patch", "full_outer"])
def test_rewrite_of_a_heavy_date_is_spread_over_tasks(spark, tmp_path, settings, strategy):
    # A heavy partition can be split into as many parts as there are tasks before it.
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1m", spark__sql__shuffle__partitions="16"
    )
    schema = schema_of("k bigint, pad string, day string")
    table = Table(spark, str(tmp_path / "t"), schema, "day")
    day = F.when(F.col("id") % 3 < 2, "heavy").otherwise(F.concat(F.lit("d"), F.col("id") % 5))
    rows = spark.range(N).select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"), day.alias("day")
    )
    table.append(rows, balance=True)
    table.merge(rows.filter("k % 1000 = 0").withColumn("pad", F.lit("new")), ["k"], ["day"], strategy=strategy)
    assert table.read().count() == N
    assert table.read().filter("pad = 'new'").count() == N // 1000
    heavy = [f for f in table.read().inputFiles() if "_version=2-" in f and "day=heavy" in f]
    assert len(heavy) > 4
