from itertools import permutations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.lastwriter import RANKS, fold, ranked
from millrace.operators.merge import merge
from millrace.plans.refine import Layers, ingest
from tests.lms_rows import csv_text, row

SCHEMA = "k int, a string, b double"
cell = st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.one_of(st.none(), st.sampled_from([1.0, 2.0])))
batch = st.dictionaries(st.integers(0, 3), cell, max_size=4)


def frame(spark, content, rank):
    return ranked(spark.createDataFrame([(k, *v) for k, v in content.items()], SCHEMA), ["a", "b"], F.lit(rank))


def by_hand(batches):
    cells = {}
    for rank, content in batches:
        for k, values in content.items():
            for c, value in enumerate(values):
                if value is not None:
                    cells[k, c] = max(cells.get((k, c), (rank, value)), (rank, value))
    keys = {k for _, content in batches for k in content}
    return sorted(((k, *(cells.get((k, c), (None, None))[1] for c in (0, 1))) for k in keys), key=repr)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.tuples(st.integers(1, 2), batch), min_size=3, max_size=3))
def test_any_order_and_repeats_end_in_one_result(spark, rows, batches):
    frames = [frame(spark, content, rank) for rank, content in batches]
    expected = by_hand(batches)
    for n, order in enumerate(permutations(frames)):
        table = order[0]
        for df in (*order[1:], order[0]):
            table = merge(table, df, ["k"], ranks=RANKS, strategy=("patch", "full_outer")[n % 2])
        assert rows(table.drop(RANKS)) == expected
    every = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert rows(fold(every, ["k"]).drop(RANKS)) == expected


def test_folding_combines_before_the_shuffle(spark, plan):
    df = ranked(spark.range(100).selectExpr("id % 3 as k", "cast(id as string) as a"), ["a"], F.col("k"))
    text = plan(fold(df, ["k"]))
    assert text.count("partial_max") >= 1 and "Window" not in text


@pytest.mark.parametrize("order", [(0, 1, 2), (0, 2, 1), (2, 1, 0)])
def test_bronze_does_not_depend_on_the_order_of_days(spark, tmp_path, rows, order):
    """A value, a correction, a gap: always the correction."""
    days = ["2024-01-15", "2024-01-16", "2024-01-17"]
    drops = [row("1", Name="x1", Status="Open"), row("1", Name="x2", Status=None, Grade_Level="10"), row("1", Name=None, Status=None, Grade_Level=None, Final_Grade="B")]
    layers = Layers(spark, str(tmp_path / "t"))
    for n in order:
        folder = tmp_path / f"drops{n}"
        folder.mkdir()
        (folder / "d.csv").write_text(csv_text(drops[n]))
        ingest(spark, str(folder), layers.landing, days[n])
        layers.refresh_pending()
    stored = layers.bronze.read().first()
    assert (stored.Name, stored.Status, stored.Grade_Level, stored.Final_Grade) == ("x2", "Open", "10", "B")
    assert stored.Newest_Batch_Date == days[2]
    silver = layers.silver.read().first()
    assert (silver.Name, silver.Status, silver.Final_Grade) == ("x2", "Open", "B")
    assert layers.fact.read().first().Final_Grade == "B"
    assert layers.star["dim_student"].read().first().Name == "x2"
