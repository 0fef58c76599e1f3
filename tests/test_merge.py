import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.merge import delete_then_append, merge

SCHEMA = "k1 string, k2 int, a string, b double, day string"
KEYS = ["k1", "k2"]
STRATEGIES = ["patch", "full_outer"]

value = st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.one_of(st.none(), st.sampled_from([1.0, 2.0])))
table = st.dictionaries(st.tuples(st.sampled_from("pqr"), st.integers(0, 2)), value, max_size=6)


def frame(spark, content, day):
    return spark.createDataFrame([(*k, *v, day) for k, v in content.items()], SCHEMA)


def by_hand(base, new, policy):
    result = {k: (*v, "old") for k, v in base.items()}
    for key, row in new.items():
        if key not in base:
            result[key] = (*row, "new")
        elif policy == "overwrite":
            result[key] = (*row, "old")
        else:
            result[key] = (*(n if n is not None else o for n, o in zip(row, base[key])), "old")
    return sorted(((*k, *v) for k, v in result.items()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=table, new=table, policy=st.sampled_from(["keep_old", "overwrite"]))
def test_strategies_agree_with_a_plain_loop(spark, rows, base, new, policy):
    b, n = frame(spark, base, "old"), frame(spark, new, "new")
    for strategy in STRATEGIES:
        merged = merge(b, n, KEYS, ["day"], policy, strategy)
        assert rows(merged) == by_hand(base, new, policy)
        assert merged.schema.names == b.schema.names


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=table, new=table)
def test_merging_a_batch_twice_changes_nothing(spark, rows, base, new):
    b, n = frame(spark, base, "old"), frame(spark, new, "new")
    once = merge(b, n, KEYS, ["day"])
    assert rows(merge(once, n, KEYS, ["day"])) == rows(once)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_keys_match_nothing_and_are_carried_through(spark, rows, strategy):
    b = spark.createDataFrame([(None, 1, "old")], "k1 string, k2 int, a string")
    n = spark.createDataFrame([(None, 1, "new")], b.schema)
    assert rows(merge(b, n, KEYS, strategy=strategy)) == [(None, 1, "new"), (None, 1, "old")]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_batch_takes_the_types_of_the_table(spark, rows, strategy):
    b = spark.createDataFrame([("p", 1, dt.date(2024, 1, 1))], "k1 string, k2 int, d date")
    n = spark.createDataFrame([("p", 1, "2024-02-01"), ("q", 1, "2024-03-01")], "k1 string, k2 bigint, d string")
    merged = merge(b, n, KEYS, strategy=strategy)
    assert merged.schema["d"].dataType == b.schema["d"].dataType
    assert rows(merged) == [("p", 1, dt.date(2024, 2, 1)), ("q", 1, dt.date(2024, 3, 1))]


def test_columns_a_batch_lacks_or_adds(spark, rows):
    b = spark.createDataFrame([("p", 1, "old")], "k1 string, k2 int, a string")
    n = spark.createDataFrame([("p", 1), ("q", 1)], "k1 string, k2 int")
    assert rows(merge(b, n, KEYS)) == [("p", 1, "old"), ("q", 1, None)]
    with pytest.raises(ValueError, match="not in the table"):
        merge(n, b, KEYS)
    with pytest.raises(ValueError, match="null_policy"):
        merge(b, n, KEYS, null_policy="?")
    with pytest.raises(ValueError, match="strategy"):
        merge(b, n, KEYS, strategy="?")


def test_delete_then_append_replaces_whole_rows(spark, rows):
    b = spark.createDataFrame([("p", 1, "old"), ("q", 1, "old")], "k1 string, k2 int, a string")
    n = spark.createDataFrame([("p", 1, None), ("r", 1, "new")], b.schema)
    assert rows(delete_then_append(b, n, KEYS)) == sorted(
        [("p", 1, None), ("q", 1, "old"), ("r", 1, "new")], key=repr
    )


@pytest.fixture
def stored(spark, tmp_path):
    """A larger base and a small batch, both read from files."""
    base, new = str(tmp_path / "base"), str(tmp_path / "new")
    spark.range(200_000).selectExpr("id", "id * 2 as v", "cast(id as string) as pad").write.parquet(base)
    spark.range(199_990, 200_010).selectExpr("id", "-1L as v", "'n' as pad").write.parquet(new)
    return spark.read.parquet(base), spark.read.parquet(new)


def test_small_batch_streams_past_an_unshuffled_base(stored, plan):
    merged = merge(*stored, ["id"])
    merged.write.format("noop").mode("overwrite").save()
    text = plan(merged)
    assert "LeftOuter, BuildRight" in text and "SortMergeJoin FullOuter" not in text
    wide_branch = text[: text.index("LeftSemi")]
    patched = wide_branch[wide_branch.index("LeftOuter"):]
    assert "Exchange hashpartitioning" not in patched.split("BroadcastExchange")[0]
    assert merged.count() == 200_010


def test_batch_beyond_the_broadcast_limit_takes_one_shuffled_join(stored, plan, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    merged = merge(*stored, ["id"])
    assert "FullOuter" in plan(merged) and "Broadcast" not in plan(merged)
    assert merged.count() == 200_010
    settings(spark__sql__autoBroadcastJoinThreshold="100b")
    assert "FullOuter" in plan(merge(*stored, ["id"]))
    settings(spark__sql__autoBroadcastJoinThreshold="1m")
    assert "FullOuter" not in plan(merge(*stored, ["id"]))
