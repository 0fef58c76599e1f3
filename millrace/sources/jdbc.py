"""JDBC tables.

A plain read uses one partition, like any JDBC scan without bounds.  For a
large table give ``partition_column``, its bounds and ``num_partitions``, so
the executors read ranges of it side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def connection_options(url: str, table: str, driver: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "driver": driver}


def read_options(
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> dict[str, str]:
    """Options of a parallel read; the four partition options go together."""
    together = {
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
    }
    given = {name: str(value) for name, value in together.items() if value is not None}
    if given and len(given) < len(together):
        missing = sorted(set(together) - set(given))
        raise ValueError(f"a partitioned JDBC read also needs {missing}")
    if fetch_size is not None:
        given["fetchsize"] = str(fetch_size)
    return given


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, driver: str, **parallel
) -> DataFrame:
    """A table as a DataFrame; ``parallel`` as for ``read_options``."""
    options = connection_options(url, table, driver) | read_options(**parallel)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    driver: str,
    mode: str = "append",
    batch_size: int | None = None,
    num_partitions: int | None = None,
    truncate: bool = False,
) -> DataFrameWriter:
    options = connection_options(url, table, driver)
    if batch_size is not None:
        options["batchsize"] = str(batch_size)
    if num_partitions is not None:
        options["numPartitions"] = str(num_partitions)
    if truncate:
        options["truncate"] = "true"
    return df.write.format("jdbc").options(**options).mode(mode)


def write_jdbc_table(
    df: DataFrame, url: str, table: str, driver: str, mode: str = "append", **tuning
) -> None:
    """Write a frame; ``tuning`` is ``batch_size``, ``num_partitions``, ``truncate``.

    ``truncate`` makes an overwrite keep the table's own column types.
    """
    jdbc_writer(df, url, table, driver, mode, **tuning).save()
