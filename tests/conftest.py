from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from millrace.session import tune


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def plan():
    """The physical plan of a frame as text; the final one once the frame has run."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)
